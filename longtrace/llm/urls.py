"""URL filters: host and path rules, then a logistic regression on hashed character n-grams."""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: n-grams of these lengths fall into BUCKETS places.
LENGTHS = (3, 4, 5)
BUCKETS = 1 << 12

#: The rules of the op8 query, (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: A small labelled table of invented URLs; no host of a given table, and none of its blocked hosts' words.
BLOCKED = """
https://royal-roulette.test/en/3 http://www.roulette-online.test/es/18 https://m.lucky-roulette.test/de/5 https://blog.big-jackpot.test/en/4/
https://poker-jackpot.test/en/40 http://slots-poker.test/fr/7.html https://jackpot-slots.test/en/12 https://lucky-slots.test/en/31
http://m.poker-online.test/de/2 https://sports-gambling.test/es/6/ https://www.gambling-tips.test/en/15 http://bingo-lotto.test/en/8
https://lotto-jackpot.test/en/61 http://www.online-lotto.test/it/4 https://bingo-gambling.test/play/9 http://lucky-bingo.test/play?id=3
https://buy-viagra.test/en/2 http://www.viagra-online.test/fr/16 https://m.diet-tablets.test/en/14/ https://blog.buy-cialis.test/en/6
https://cialis-discount.test/shop/1 http://discount-viagra.test/shop/88 https://diet-miracle.test/en/17 http://miracle-tablets.test/es/2
https://quick-loans.test/es/3 http://payday-loans.test/en/21.html https://replica-watches.test/de/10 https://designer-replica.test/en/5
https://www.payday-credit.test/en/7 http://instant-loans.test/fr/70 https://no-credit-loans.test/apply/2 http://replica-bags.test/shop/11
https://porn-videos.test/en/5 http://m.porn-cams.test/fr/19 https://www.xxx-porn.test/en/23/ https://blog.xxx-videos.test/de/11
https://hot-porn.test/en/9 https://live-sex-cams.test/en/60 http://hot-xxx.test/es/44 https://xxx-cams.test/en/8.html
https://escort-girls.test/en/30 http://sex-escort.test/fr/4/ https://m.hot-escort.test/de/13 https://sex-dating.test/en/71
http://click-popup.test/en/2 https://popup-banner.test/es/9 https://banner-click.test/redirect/1 http://popup-redirect.test/en/90
https://link-exchange.test/en/5 http://buy-links.test/seo/3 https://seo-links.test/de/41 http://link-seo.test/backlinks/77
https://crack-warez.test/en/1 http://warez-keygen.test/get/5 https://keygen-crack.test/en/24 http://torrent-warez.test/get/31
""".split()
ALLOWED = """
http://harbour-news.test/en/1 https://www.daily-herald.test/fr/22.html http://garden-notes.test/de/9 https://m.townhall.test/en/77/
https://riverside.test/en/3 http://www.museum.test/es/18 https://m.library.test/de/5 https://blog.kitchen.test/en/4/
https://university.test/en/40 http://weather.test/fr/7.html https://gazette.test/en/12 https://mountains.test/en/31
http://m.recipes.test/de/2 https://astronomy.test/es/6/ https://www.council.test/en/15 http://orchestra.test/en/8
https://nature.test/en/2 http://www.theatre.test/fr/16 https://m.railway.test/en/14/ https://blog.history.test/en/6
https://bakery.test/es/3 http://lighthouse.test/en/21.html https://painters.test/de/10 https://thornton.test/en/5
https://whitherton.test/en/5 http://m.northand.test/fr/19 https://www.tionering.test/en/23/ https://blog.theatres.test/de/11
https://anthology.test/en/9 https://station-road.test/en/60 http://therein.test/es/44 https://thatched.test/en/8.html
https://www.nationhe.test/en/30 http://rationing.test/fr/4/ https://m.thinner.test/de/13 https://motions.test/en/71
http://heathland.test/en/2 https://notions.test/es/9 https://blog.stationhouse.test/en/1 http://thames.test/en/90
https://old-mill.test/en/9 http://www.book-club.test/es/5 https://m.city-library.test/de/27 https://blog.green-garden.test/en/2
https://river-walk.test/it/8 http://school-choir.test/en/13 https://www.night-sky.test/fr/3 http://home-bread.test/en/6.html
https://m.train-times.test/en/50 http://parish-council.test/es/1 https://folk-music.test/shop/2 http://bird-watch.test/en/16
""".split()


#: Endings that the hosts of the table take in turn, so that an ending tells nothing.
ENDINGS = (".test", ".example.org", ".example.net", ".example.com")
BLOCKED, ALLOWED = ([u.replace(".test", ENDINGS[k % len(ENDINGS)]) for k, u in enumerate(urls)] for urls in (BLOCKED, ALLOWED))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; without `://`, or null: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_match(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls; rules are few and become one expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for told, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, told).otherwise(verdict)
    return name, verdict


def places(host: Column, path: Column) -> Column:
    """Places of the n-grams of host and path, each part marked at its ends."""

    def grams(text: Column, n: int) -> Column:
        starts = F.when(F.char_length(text) >= n, F.sequence(F.lit(1), F.char_length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int"))

    marked = [F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.lit(">"), path, F.lit("<"))]
    return F.concat(*(grams(t, n) for t in marked for n in LENGTHS))


def labelled(spark: SparkSession, blocked: list[str], allowed: list[str]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(y).alias("y")) for y, urls in ((1.0, blocked), (0.0, allowed)) for u in urls))
    return spark.range(1).select(F.inline(rows))


def train(table: DataFrame, reg: float = 1e-4, benign_weight: float = 2.0) -> tuple[list[float], float]:
    """(weights, bias) from a small table of (url, y): y 1.0 is to be blocked.

    A place counts in units of one over the root of the URL's n-grams. URLs to allow
    weigh benign_weight times as much, as most unknown URLs are such.
    """
    p = places(*host_and_path(F.col("url")))
    grams = table.select("url", "y", F.explode(p).alias("place"), F.sqrt(F.size(p).cast("double")).alias("n"))
    counts = grams.groupBy("url", "y", "place").agg((F.count("*") / F.first("n")).alias("x"))
    rows = counts.groupBy("url", "y").agg(F.map_from_entries(F.collect_list(F.struct("place", "x"))).alias("c"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda k: F.coalesce(F.try_element_at("c", k), F.lit(0.0)))
    counted = rows.select("y", F.when(F.col("y") == 1, 1.0).otherwise(benign_weight).alias("weight"), dense.alias("x")).coalesce(1)
    cached = counted.select("y", "weight", array_to_vector("x").alias("x")).cache()
    model = LogisticRegression(featuresCol="x", labelCol="y", weightCol="weight", regParam=reg, standardization=False, maxIter=40).fit(cached)
    cached.unpersist()
    return [float(w) for w in model.coefficients], float(model.intercept)


def score(host: Column, path: Column, weights: list[float], bias: float) -> Column:
    """Probability that a URL is to be blocked."""
    w = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    p = places(host, path)
    total = F.aggregate(F.transform(p, lambda k: F.get(w, k)), F.lit(0.0), lambda a, x: a + x)
    return 1 / (1 + F.exp(-(total / F.greatest(F.sqrt(F.size(p).cast("double")), F.lit(1.0)) + bias)))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], weights: list[float], bias: float, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, score, verdict), a row for each row of pages.

    The longest rule that fits decides; else a score of threshold or more blocks.
    (The defaults were chosen by folds over the hosts of the training table alone.)
    Null URLs and such without `://` have an empty host and path and no rule;
    a very long URL is scored whole; repeated rows and null ids stay; no rows give no
    rows; other columns, such as the page itself, aren't read.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    scored = parts.withColumns({"rule": rule, "told": verdict, "score": score(F.col("host"), F.col("path"), weights, bias)})
    own = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", "score", F.coalesce("told", own).alias("verdict"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights, bias = train(labelled(spark, BLOCKED, ALLOWED))
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES, weights, bias).select("page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))
