import random
import re
from hashlib import sha256

import numpy as np
import pytest
from helpers import documents

from tenorline.llm import substring_dedup
from tenorline.llm.substring_dedup import (
    ANCHOR, WINDOW, Block, remove_repeats, run_hashes, segments, spans_of, word_hashes,
)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_force(rows):
    """[(doc_id, n_words, n_removed, sha of kept words)] with every window of every row looked up."""
    first = {}
    for i, text in rows:
        w = split(text)
        for k in range(len(w) - WINDOW + 1) if i is not None else ():
            window = tuple(w[k:k + WINDOW])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, text in rows:
        w = split(text)
        gone = [False] * len(w)
        for k in range(len(w) - WINDOW + 1) if i is not None else ():
            if first[tuple(w[k:k + WINDOW])] < i:
                gone[k:k + WINDOW] = [True] * WINDOW
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), sha256(kept.encode()).hexdigest()))
    return out


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()),
                  key=lambda r: (r[0] is not None, r))


def by_value(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    prose = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passages = [prose(n) for n in (49, 50, 51, 70, 130, 400)]
    texts = []
    for _ in range(60):  # passages in ever different surroundings, parts of them too
        w = prose(rng.randint(0, 30))
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            a = rng.choice([0, 0, rng.randrange(len(p))])
            w += p[a:rng.choice([len(p), a + rng.randint(1, len(p))])] + prose(rng.choice([0, 0, 1, 40]))
        texts.append(w)
    for _ in range(20):  # near copies
        w = list(passages[-1])
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        texts.append(w)
    texts += [["a"] * n for n in (49, 50, 51, 300)] + [["a", "b"] * 60, ["b", "a"] * 60, ["x"] + ["a"] * 120]
    rows = [" ".join(w) for w in texts]
    rows += [rows[3], rows[3].replace(" ", "\n"), rows[5].upper(), None, "", " \t", "one", rows[7] + " end"]
    long = prose(20_000)
    rows += [" ".join(long), " ".join(prose(50) + long[5000:15_000])]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("most_segments", [2, 2000])
def test_matches_every_window_looked_up(spark, corpus, most_segments):
    got = result(remove_repeats(documents(spark, corpus), most_segments=most_segments))
    want = brute_force(corpus)
    assert got == by_value(want)
    assert sum(0 < r[2] < r[1] for r in want) > 40 and sum(r[2] == 0 and r[1] > 60 for r in want) >= 5


def test_only_anchors_of_two_documents_are_followed(spark, monkeypatch):
    rng = random.Random(5)
    prose = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passage, own = prose(80), prose(70)
    rows = [(k, " ".join(prose(400))) for k in range(20)]
    rows += [(20, " ".join(prose(30) + passage + prose(30))), (21, " ".join(prose(30) + passage))]
    rows += [(22, " ".join(own + prose(9) + own + prose(9) + own))]  # repeats itself only
    counts, write = {}, substring_dedup.written

    def counted(df, label, *more):
        out = write(df, label, *more)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(substring_dedup, "written", counted)
    assert result(remove_repeats(documents(spark, rows))) == by_value(brute_force(rows))
    assert counts["segments"] > 150
    assert 0 < counts["distinct"] <= 16 and 0 < counts["fetched"] <= 16


def test_kept_text(spark):
    same = " ".join(f"s{k}" for k in range(60))
    rows = [(1, f"start {same} end"), (2, f"Other  {same}\nlast"), (3, same), (4, "short")]
    got = {r["doc_id"]: r["kept"] for r in remove_repeats(documents(spark, rows)).collect()}
    assert got == {1: None, 2: "Other last", 3: "", 4: None}


def test_nulls_and_repeated_ids(spark):
    a, b = " ".join(f"a{k}" for k in range(70)), " ".join(f"b{k}" for k in range(70))
    rows = [(None, a), (None, a), (3, a + " x"), (3, b), (3, b), (3, b.replace(" ", "  ")), (5, b + " y"), (5, a), (7, None), (7, "")]
    assert result(remove_repeats(documents(spark, rows))) == by_value(brute_force(rows))


def test_empty_table(spark):
    got = remove_repeats(documents(spark, []))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"] and got.count() == 0


def test_longest_matches_with_earlier_documents():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 60, 40)
    words = rng.integers(0, 3, lengths.sum()).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    docs = rng.integers(0, 12, 40)
    block = Block(words, np.repeat(docs, lengths), starts)
    texts = [words[a:a + n].tolist() for a, n in zip(starts, lengths)]
    for k, (a, n) in enumerate(zip(starts, lengths)):
        for i in range(n):
            best = 0
            for j in range(40):
                if docs[j] < docs[k]:
                    for at in range(lengths[j]):
                        m = 0
                        while i + m < n and at + m < lengths[j] and texts[k][i + m] == texts[j][at + m]:
                            m += 1
                        best = max(best, m)
            assert block.longest[a + i] == best
    start, length = block.factors()
    assert (start + length == np.append(start[1:], len(words))).all()


def test_equal_windows_have_one_anchor():
    rng = random.Random(1)
    shared = [b"s%d" % rng.randrange(500) for _ in range(WINDOW)]
    seen = set()
    for _ in range(20):
        before = [b"p%d" % rng.randrange(500) for _ in range(rng.randrange(100))]
        hashes = word_hashes(before + shared + [b"q"] * rng.randrange(100))
        anchor, start, windows = segments(hashes)
        k = int(np.searchsorted(start, len(before), side="right")) - 1
        assert start[k] <= len(before) < start[k] + windows[k]
        assert anchor[k] in run_hashes(word_hashes(shared), ANCHOR)
        seen.add(int(anchor[k]))
    assert len(seen) == 1


def test_spans():
    flags = np.zeros(400, bool)
    flags[[3, 4, 54, 105, 300]] = True
    assert spans_of(flags) == [{"first": 3, "behind": 104}, {"first": 105, "behind": 155}, {"first": 300, "behind": 350}]
