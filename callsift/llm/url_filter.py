"""URL filters: rules on hosts and paths, and a logistic regression for the URLs that no rule decides.

The regression sees hashed character n-grams of host and path.  It learns from
a small labelled table, in the dual form: one coefficient for each labelled
URL, found by gradient steps over the table of their inner products, from
which the weights of the buckets follow.  Both tables are small whatever the
number of URLs to judge.  All is DataFrame functions.

Rules are joined by host: each distinct host is looked up once with all its
parent domains, so a host that many URLs share costs one lookup, and its rules
come back as one sorted array.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.session import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    """``orders``: lengths of n-grams; ``most_urls``: labelled URLs that a model is learned from, at most (more are refused).

    ``rounds`` steps of ``step`` size are made; ``decay`` keeps weights small;
    URLs that score ``threshold`` or more are blocked.
    """

    orders: tuple[int, ...] = (2, 3, 4)
    buckets: int = 1 << 14
    most_urls: int = 400
    rounds: int = 300
    step: float = 4.0
    decay: float = 1e-4
    threshold: float = 0.5


# Labelled URLs to learn from: fixed values, a parameter of the query.
BLOCKED = """
casino-royal.example/en/1 www.casino-online.test/play/20 bigwin-casino.test/slots.html m.casinobonus.example/spin?x=1 lucky-casino.example/de/302
pokerwin.test/table/9 online-poker.example/fr/88 free-slots.test/win/7 jackpot-win.example/es/12 win-big.test/en/4
betting-odds.test/odds/1 sportbets.example/en/55 bets-today.test/fr/312.html bet-now.example/bet www.bestbets.example/es/7
slimming-pills.test/buy/3 pills-online.example/en/71 www.diet-pills.example/order cheapmeds.test/de/8 cheap-viagra.example/es/9
buy-cheap.test/shop?ref=a pills4u.example/fr/3002 cheap-watches.example/en/10 replica-watches.test/it/1 cheap-loans.test/apply
payday-loans.example/now quick-loans.test/en/40 free-money.example/claim free-prize.test/en/2 free-iphone.example/win
adult-chat.test/en/18 adultvideos.example/watch/6 adult-cams.test/de/71 xxx-tube.example/v/12 hot-x.test/fr/5
adult-photos.test/1 porn-x.example/en/30 sexcams.example/live m.adult-dating.example/es/10 x-videos.test/en/21
spam-mail.test/out spam-links.example/en/4 linkfarm.example/fr/1 link-farm.test/en/90 contentfarm.test/es/66
spamsite.test/de/12 farm-links.example/x ads-server.test/click adtrack.example/pixel?u=1 ad-click.test/r/17
ad-pixels.example/en/2 ads-network.example/b/11 tracker.test/t.gif click-track.example/go popads.test/p/3
"""
ALLOWED = """
library.example/en/1 www.library-town.test/opening/20 city-museum.test/rooms.html m.newspaper.example/local?x=1 university.example/de/302
weather.test/table/9 online-maps.example/fr/88 school.test/news/7 recipes.example/es/12 garden.test/en/4
history.test/page/1 science.example/en/55 health-service.test/fr/312.html government.example/law www.hospital.example/es/7
books.test/read/3 music.example/en/71 www.travel-notes.example/order bicycle.test/de/8 mountain-club.example/es/9
railway.test/time?ref=a parliament.example/fr/3002 physics.example/en/10 mathematics.test/it/1 post-office.test/apply
blog.anders.example/now theory.test/en/40 blog.nation.example/claim other.test/en/2 m.weather-report.example/win
www.anything.test/en/18 stations.example/watch/6 thread.test/de/71 blog.mother.example/v/12 nothing.test/fr/5
monthly.test/1 thousand.example/en/30 earth.example/live m.together.example/es/10 strength.test/en/21
forum.test/out community.example/en/4 wiki.example/fr/1 docs.test/en/90 manual.test/es/66
archive.test/de/12 encyclopedia.example/x photo-album.test/click research.example/pixel?u=1 teacher.test/r/17
cinema.example/en/2 theatre.example/b/11 kitchen.test/t.gif football-club.example/go village.test/p/3
"""


def labelled_urls(spark) -> DataFrame:
    """(url, block) of the labelled URLs above."""
    rows = [(f"http://{url}", block) for urls, block in ((BLOCKED, True), (ALLOWED, False)) for url in urls.split()]
    return spark.createDataFrame(rows, "url string, block boolean")


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(host: Column, path: Column, settings: Settings = Settings()) -> Column:
    """Bucket (from 0) of each n-gram of ``|host|`` and of ``|path|``: hosts in even buckets, paths in odd ones."""
    half = settings.buckets // 2

    def of(text: Column, place: int, order: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - (order - 1), F.lit(1)))
        return F.transform(starts, lambda i: (F.crc32(F.substr(text, i, F.lit(order)).cast("binary")) % half * 2 + place).cast("int"))

    marked = [F.concat(F.lit("|"), text, F.lit("|")) for text in (host, path)]
    found = [of(text, place, order) for place, text in enumerate(marked) for order in settings.orders]
    return F.concat(*found)


#: The bucket of a feature that is 1 in all URLs.
BIAS = -1


@dataclass(frozen=True)
class Model:
    """``bias``, and ``weights``: (bucket, weight) of the buckets that count."""

    bias: float
    weights: tuple[tuple[int, float], ...]
    settings: Settings


def fit(labelled: DataFrame, url: str, block: str, settings: Settings = Settings()) -> Model:
    """The regression of ``block`` (boolean) on the n-grams of ``url`` and a bias.

    Rows without a label are left out; repeated rows count as often.  A URL's
    features are its counts of buckets, divided by the root of the number of
    its n-grams.  Without any labelled row all weights and the bias are 0.
    The table is refused above ``most_urls`` rows, as its inner products are
    one array.
    """
    address = F.col(url)
    rows = labelled.filter(F.col(block).isNotNull()).select(F.col(block).alias("_y"), grams(host_of(address), path_of(address), settings).alias("_grams"))
    held = stage(rows.withColumn("_id", F.monotonically_increasing_id()))
    number = held.count()
    if number > settings.most_urls:
        raise ValueError(f"{number} labelled URLs, at most {settings.most_urls}: take a sample or raise most_urls")
    counted = held.select("_id", "_y", (1 / F.sqrt(F.size("_grams"))).alias("_unit"), F.explode("_grams").alias("_bucket"))
    cells = counted.groupBy("_id", "_y", "_bucket").agg(F.sum("_unit").alias("_x"))
    cells = stage(cells.unionByName(held.select("_id", "_y", F.lit(BIAS).alias("_bucket"), F.lit(1.0).alias("_x"))))
    other = cells.select(F.col("_id").alias("_other"), "_bucket", F.col("_x").alias("_z"))
    # the labelled URLs are few, and all of them share the bias: each has its products with all others
    products = cells.join(other, "_bucket").groupBy("_id", "_y", "_other").agg(F.sum(F.col("_x") * F.col("_z")).alias("_p"))
    lines = products.groupBy("_id", "_y").agg(F.array_sort(F.collect_list(F.struct("_other", "_p"))).alias("_line"))
    whole = lines.agg(F.array_sort(F.collect_list(F.struct("_id", "_y", F.col("_line._p").alias("_k")))).alias("_urls"))
    table = stage(whole.select(F.col("_urls._id").alias("_ids"), F.transform("_urls._y", lambda y: y.cast("double")).alias("_ys"), F.col("_urls._k").alias("_k")))

    def descend(at: Column, _) -> Column:
        def one(k: Column, i: Column) -> Column:
            score = F.aggregate(F.zip_with(k, at, lambda p, a: p * a), F.lit(0.0), lambda s, x: s + x)
            y, a = F.get("_ys", i), F.get(at, i)
            return a + settings.step / F.size("_ys") * (y - 1 / (1 + F.exp(-score))) - settings.step * settings.decay * a

        return F.transform("_k", one)

    zeros = F.transform("_ids", lambda _: F.lit(0.0))
    solved = table.select("_ids", F.aggregate(F.sequence(F.lit(1), F.lit(settings.rounds)), zeros, descend).alias("_a"))
    solved = stage(solved.select(F.explode(F.arrays_zip("_ids", "_a")).alias("_s")).select(F.col("_s._ids").alias("_id"), F.col("_s._a").alias("_a")))
    weighed = cells.join(solved, "_id").groupBy("_bucket").agg(F.sum(F.col("_x") * F.col("_a")).alias("w"))
    # as many rows as buckets at most
    weights = {r["_bucket"]: r["w"] for r in weighed.collect()}
    return Model(weights.pop(BIAS, 0.0), tuple(sorted(weights.items())), settings)


def score(host: Column, path: Column, model: Model) -> Column:
    """Probability that a URL is to be blocked."""
    values = [0.0] * model.settings.buckets
    for bucket, weight in model.weights:
        values[bucket] = weight
    # one constant of the plan, as long as there are buckets
    table = F.from_json(F.lit(json.dumps(values)), "array<double>")
    found = grams(host, path, model.settings)
    total = F.aggregate(found, F.lit(0.0), lambda s, b: s + F.get(table, b))
    return 1 / (1 + F.exp(-(total / F.sqrt(F.size(found)) + model.bias)))


def parents(host: Column) -> Column:
    """A host and all domains above it."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(_of, _rules): the rules that fit each host of ``hosts`` (host) for some path, longest first.

    A rule is a host, or a domain above it, and the beginning of a path.  Of
    equally long rules the one that blocks goes first, then by text.
    """
    text = F.col("rule")
    at = F.locate("/", text)
    cut = rules.filter(text.isNotNull() & F.col("verdict").isNotNull()).select(
        F.translate(F.when(at > 0, F.substr(text, F.lit(1), at - 1)).otherwise(text), _UPPER, _LOWER).alias("_domain"),
        F.struct(
            (-F.char_length(text)).alias("length"),
            (F.col("verdict") != "block").alias("allows"),
            text.alias("rule"),
            F.when(at > 0, F.substr(text, at)).otherwise(F.lit("")).alias("path"),
            F.col("verdict").alias("verdict"),
        ).alias("_rule"),
    )
    # a row for each domain, however many rules it has
    by_domain = cut.groupBy("_domain").agg(F.collect_set("_rule").alias("_some"))
    asked = hosts.select("host").distinct().select("host", F.explode(parents(F.col("host"))).alias("_domain"))
    found = asked.join(by_domain, "_domain").groupBy("host").agg(F.array_sort(F.flatten(F.collect_list("_some"))).alias("_rules"))
    return found.withColumnRenamed("host", "_of")


def judge(df: DataFrame, key: str, url: str, rules: DataFrame, model: Model) -> DataFrame:
    """key, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of every row.

    The longest rule that fits decides (null if none fits, then the score
    does).  ``rules``: rule and verdict (``allow`` or ``block``).  A rule's
    host is compared without case, its path as it stands; rows of ``rules``
    that hold a null say nothing.  A null URL, or one without ``://``, has an
    empty host and path, which only the regression judges.  Every row counts,
    also where keys are null or repeat.
    """
    rows = df.select(F.col(key).alias("_key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    known = stage(rules_of_hosts(rows, rules))
    # hosts are unique on the right, so adaptive execution can split a host that many rows share
    placed = rows.join(known, F.col("host") == F.col("_of"), "left")
    fitting = F.get(F.filter("_rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    judged = placed.withColumn("_rule", fitting).withColumn("score", score(F.col("host"), F.col("path"), model))
    learned = F.when(F.col("score") >= model.settings.threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("_key").alias(key),
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), learned).alias("verdict"),
        "score",
    )
