"""A small table of labelled URLs: made-up addresses of the kinds that crawls skip or keep."""

BLOCK = """
http://www.grand-casino.example/slots/play
https://casino-bonus24.example/en/free-spins?ref=mail
http://online-casino-games.example/jackpot.html
https://m.bets-today.example/odds/football
http://free-betting-tips.example/en/
https://sport-bets.example/live#now
http://poker-win-cash.example/tournament
https://win-big-lottery.example/claim?id=7
http://cheap-meds-online.example/order
https://pills-discount.example/en/cheap-pills
http://pharma-pills-shop.example/buy/now.html
https://cheap-replica-watches.example/sale
http://adult-videos.example/watch/1
https://xx-adult-cams.example/live
http://adult-dating-x.example/en/join
https://porn-tube.example/video/22
http://spam-links.example/directory/
https://link-farm-seo.example/en/backlinks
http://content-farm.example/article123.html
https://spammy-news-farm.example/clickbait
http://ads-server.example/banner?id=5
https://track-pixel.example/collect?u=1
http://ad-tracking.example/click/9
https://popup-ads.example/offer
http://free-money-now.example/win
https://crypto-doubler.example/free-coins
http://payday-loans-fast.example/apply
https://clicks-tracker.example/r?x=2
""".split()

ALLOW = """
https://www.city-library.example/en/opening-hours
http://blog.garden-notes.example/spring/tulips.html
https://m.weather-report.example/de/berlin
https://open-university.example/courses/physics?page=2
http://www.history-museum.example/es/exhibitions/
https://recipes.home-kitchen.example/fr/soup#steps
http://railway-times.example/timetable/2021
https://docs.number-tools.example/en/reference/index.html
http://mountain-club.example/routes/north
https://www.daily-herald.example/politics/article-3321
http://school-board.example/minutes/march.html
https://blog.ocean-science.example/en/whales
http://music-archive.example/scores/bach
https://m.town-council.example/fr/contact
http://language-forum.example/thread/812?page=3
https://www.bird-watchers.example/guide/species
http://hospital-trust.example/patients/visiting
https://blog.wood-workshop.example/tables-and-chairs
http://law-journal.example/volume/12
https://www.river-authority.example/en/levels.html
http://chess-federation.example/games/2019
https://astronomy-club.example/de/telescopes/
http://cycling-holidays.example/tours/alps
https://m.theatre-house.example/programme#june
http://statistics-office.example/data/table5
https://blog.thought-letters.example/essays/on-time
http://www.farmers-market.example/stalls
https://translation-society.example/es/members/
http://nature-photos.example/gallery/lakes
https://www.public-radio.example/en/podcasts
http://software-manual.example/install.html
https://blog.travel-diary.example/fr/lisbon
http://genealogy-records.example/parish/1820
https://m.tennis-school.example/lessons
http://stone-bridge.example/about
https://the-reading-room.example/books/332/
http://other-things.example/en/41
https://www.nation-tonight.example/de/902.html
http://blog.hand-thread.example/en/118?utm_source=feed
https://inter-station.example/fr/77#top
""".split()

LABELLED = [(u, "block") for u in BLOCK] + [(u, "allow") for u in ALLOW]
