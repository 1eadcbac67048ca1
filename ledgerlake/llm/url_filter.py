"""URL filter: rules for hosts and paths, and a linear model for all other URLs.

The model is a logistic regression on hashed character n-grams of host and path,
trained on a small table of labelled URLs. Training and judging are column
expressions alone: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters in an n-gram; buckets they are hashed to (a prime), and the factors of
#: a gram's characters. One more bucket, which every URL has, is the constant.
GRAMS, BUCKETS, FACTORS = (3, 4), 4093, (1, 1361, 2711, 3533)
#: Added to the hash of every gram of a host and of a path; root of the sum of squares
#: of their values.
HOST, PATH = (0, 1.0), (2029, 0.4)
#: Labelled URLs of each class that are learnt from, at most.
PER_CLASS = 200
#: Steps of gradient descent, the share of a step that the next one goes on with,
#: and the pull of every weight to 0.
STEPS, MOMENTUM, SHRINK = 200, 0.9, 0.02

# A small table of URLs labelled by hand.
BLOCKED_URLS = (
    "http://www.royal-casino.example.com/en/814",
    "https://casino-bonus.example.net/fr/22.html",
    "http://m.online-casino.example.org/de/5?ref=x",
    "https://big-win-slots.example.com/es/76",
    "http://jackpot-win.example.org/en/9/",
    "https://free-poker.example.net/en/431#top",
    "http://blog.poker-bets.example.com/de/18",
    "https://sports-bets.example.org/en/66",
    "http://live-betting.example.net/es/702/",
    "https://www.free-spins.example.org/fr/3",
    "http://pills-online.example.com/en/250",
    "https://cheap-meds.example.net/de/91.html",
    "http://m.cheap-viagra.example.org/fr/640",
    "https://diet-pills.example.com/es/8?utm_source=feed",
    "http://buy-pills-now.example.net/en/57",
    "https://www.adult-video.example.org/en/12/",
    "http://adult-chat.example.com/de/333",
    "https://m.adult-dating.example.net/en/35",
    "https://xxx-adult.example.net/fr/71",
    "http://m.hot-porn.example.org/es/26#top",
    "https://spam-links.example.com/en/509",
    "http://www.link-spam.example.net/de/44",
    "https://link-farm.example.org/fr/150.html",
    "http://click-farm.example.com/es/7",
    "https://content-farm.example.net/en/88?page=2",
    "http://ads-server.example.org/en/4/click",
    "https://pop-ads.example.com/fr/960",
    "http://m.click-track.example.net/de/35",
    "https://track-pixel.example.org/en/213?utm_source=ads",
    "http://www.adtracker.example.com/es/17",
    "https://free-torrents.example.net/en/640",
    "http://crack-keys.example.org/de/2.html",
    "https://quick-loans.example.com/en/77",
)
ALLOWED_URLS = (
    "http://www.library.example.com/en/310",
    "https://weather.example.org/de/12.html",
    "http://theatre.example.net/fr/45/",
    "https://blog.garden-club.example.com/en/88",
    "http://m.thermal-baths.example.org/es/7?page=2",
    "https://museum.example.net/en/501#top",
    "http://docs.example.org/en/library/index.html",
    "https://www.history.example.com/fr/620",
    "http://three-rivers.example.net/de/33",
    "https://theory.example.org/en/914?utm_source=feed",
    "http://northern-news.example.com/en/5",
    "https://therapy.example.net/es/240",
    "http://blog.thinking.example.org/en/73/",
    "https://mathematics.example.com/de/18",
    "http://m.health-guide.example.net/fr/402",
    "https://earth-science.example.org/en/66.html",
    "http://wiki.example.com/en/Main_Page",
    "https://forum.example.net/de/thread/91",
    "http://www.recipes.example.org/es/130",
    "https://school.example.com/en/27?ref=x",
    "http://university.example.net/fr/819",
    "https://blog.travel-notes.example.org/en/4",
    "http://thesaurus.example.com/en/551#top",
    "https://anthology.example.net/de/62",
    "http://m.photography.example.org/es/39/",
    "https://town-council.example.com/en/208",
    "http://www.orchestra.example.net/fr/14.html",
    "https://birds.example.org/en/700",
    "http://open-data.example.com/de/datasets/3",
    "https://journal.example.net/en/96?page=2&ref=x",
    "http://software.example.org/en/download/8",
    "https://blog.cycling.example.com/es/57",
    "http://thread-and-needle.example.net/en/342",
    "https://other-worlds.example.org/fr/25",
    "http://m.bookshop.example.com/de/610",
    "https://www.chess.example.net/en/11",
    "http://cinema.example.org/es/483.html",
    "https://bakery.example.com/fr/76/",
    "http://astronomy.example.net/en/159",
    "https://mother-tongue.example.org/de/205",
    "http://blog.together.example.com/en/64#top",
    "https://nothing-new.example.net/es/93",
    "http://www.railways.example.org/en/370",
    "https://architecture.example.com/fr/21?utm_source=feed",
    "http://philosophy.example.net/de/854",
    "https://languages.example.org/es/48",
    "http://m.the-times.example.com/en/7/",
    "https://trains.example.net/fr/266",
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case, and then up to ``?``, ``#`` or the end. Both are empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null if none fits.

    A rule ``(verdict, "host/path")`` fits its host and all subdomains where the
    path starts with the rule's. Of rules of one length the one with the longer
    host wins, then the first. The rules are a short list that is part of the plan.
    """
    rule = verdict = F.lit(None).cast("string")
    parted = [(v, r, *r.partition("/")[::2]) for v, r in rules]
    for kind, name, own, rest in sorted(reversed(parted), key=lambda r: (len(r[1]), len(r[2]))):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule = F.when(fits, name).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _buckets(text: Column, kind: int) -> Column:
    """The bucket of every n-gram of a text between two marks."""
    codes = F.transform(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: F.ascii(c).cast("long"))

    def of_size(codes: Column, n: int) -> Column:
        def bucket(i: Column) -> Column:
            total = sum((F.get(codes, i + k) * FACTORS[k] for k in range(n)), F.lit(kind + n))
            return F.pmod(total, F.lit(BUCKETS)).cast("int")

        hashed = F.transform(F.sequence(F.lit(0), F.size(codes) - n), bucket)
        return F.when(F.size(codes) >= n, hashed).otherwise(F.array().cast("array<int>"))

    return _let(codes, lambda codes: F.concat(*(of_size(codes, n) for n in GRAMS)))


def _features(host: Column, path: Column) -> Column:
    """``array<struct<b, v>>``: buckets and values. The grams of a host, and those of a
    path, have a fixed sum of squares however many there are."""

    def valued(text: Column, kind: int, norm: float) -> Column:
        def of(buckets: Column) -> Column:
            value = norm / F.sqrt(F.size(buckets))
            return F.transform(buckets, lambda b: F.struct(b.alias("b"), value.alias("v")))

        return _let(_buckets(text, kind), of)

    constant = F.array(F.struct(F.lit(BUCKETS).alias("b"), F.lit(1.0).alias("v")))
    return F.concat(valued(host, *HOST), valued(path, *PATH), constant)


def _margin(features: Column, weights: Column) -> Column:
    return F.aggregate(features, F.lit(0.0), lambda total, x: total + F.get(weights, x["b"]) * x["v"])


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The table above: ``(url, blocked)``."""
    rows = [(url, True) for url in BLOCKED_URLS] + [(url, False) for url in ALLOWED_URLS]
    table = F.array(*(F.struct(F.lit(u).alias("url"), F.lit(y).alias("blocked")) for u, y in rows))
    return spark.range(1).select(F.inline(table))


def train_url_filter(
    labelled: DataFrame, url: str = "url", blocked: str = "blocked", per_class: int = PER_CLASS
) -> DataFrame:
    """One row, ``weights array<double>``, learnt from labelled URLs.

    At most ``per_class`` URLs of each class, those of lowest hash, are learnt from;
    that bounds the single task that learns. Null URLs and labels are left out; a
    URL labelled in both ways counts as blocked. Batch gradient descent on the log
    loss with momentum; the step is small enough for any examples. No example
    leaves all weights 0. Other columns play no part.
    """
    known = (
        labelled.select(F.col(url).alias("url"), F.col(blocked).cast("boolean").alias("y"))
        .where("url is not null and y is not null")
        .groupBy("url")
        .agg(F.max(F.col("y").cast("double")).alias("y"))
    )
    order = F.xxhash64("url"), "url"
    classes = [known.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0.0, 1.0)]
    sample = classes[0].unionByName(classes[1])
    numbered = sample.select(
        (F.row_number().over(Window.orderBy("url")) - 1).alias("i"),
        "y",
        _features(*host_and_path(F.col("url"))).alias("x"),
    )
    examples = numbered.agg(F.sort_array(F.collect_list(F.struct("i", "y", "x"))).alias("examples"))
    entries = numbered.select("i", F.inline("x")).groupBy("b").agg(
        F.sort_array(F.collect_list(F.struct("i", "v"))).alias("of")
    )
    spark = labelled.sparkSession
    every = spark.range(BUCKETS + 1).select(F.col("id").cast("int").alias("b"))
    listed = every.join(entries, "b", "left").select(
        "b", F.coalesce("of", F.array().cast("array<struct<i:int,v:double>>")).alias("of")
    )
    table = listed.agg(F.sort_array(F.collect_list(F.struct("b", "of"))).alias("buckets"))
    table = table.withColumn("examples", examples.scalar())

    squares = F.aggregate(
        F.col("buckets"), F.lit(0.0),
        lambda total, l: F.aggregate(l["of"], total, lambda t, e: t + e["v"] * e["v"]),
    )
    # Half the inverse of a bound of the loss's curvature.
    step = F.coalesce(F.try_divide(F.lit(2.0), squares), F.lit(0.0))
    zeros = F.array_repeat(F.lit(0.0), BUCKETS + 1)
    start = F.struct(zeros.alias("w"), zeros.alias("v"), step.alias("step"))

    def errors(weights: Column) -> Column:
        return F.transform(
            F.col("examples"), lambda e: 1 / (1 + F.exp(-_margin(e["x"], weights))) - e["y"]
        )

    def descend(state: Column, _: Column) -> Column:
        def moved(error: Column) -> Column:
            def speed(l: Column, j: Column) -> Column:
                slope = F.aggregate(
                    l["of"], F.lit(0.0), lambda t, e: t + F.get(error, e["i"]) * e["v"]
                )
                slope = slope + SHRINK * F.get(state["w"], j)
                return MOMENTUM * F.get(state["v"], j) - state["step"] * slope

            def placed(speeds: Column) -> Column:
                weights = F.zip_with(state["w"], speeds, lambda w, v: w + v)
                return F.struct(weights.alias("w"), speeds.alias("v"), state["step"].alias("step"))

            return _let(F.transform(F.col("buckets"), speed), placed)

        return _let(errors(state["w"]), moved)

    learnt = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, descend, lambda state: state["w"])
    return table.select(learnt.alias("weights"))


def judge_urls(
    urls: DataFrame,
    model: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``(key, host, path, rule, verdict, score)``, one row per input row.

    The longest fitting rule decides, see :func:`matching_rule`; without one the
    ``model`` of :func:`train_url_filter` does: ``block`` if its log odds ``score``
    are above 0, else ``allow``. ``rule`` is null where the model decided. A null URL
    and one without ``://`` have an empty host and path, which no rule fits; the model
    judges them by its constant. Repeated rows and keys are judged each on their
    own; other columns play no part.
    """
    host, path = host_and_path(F.col(url))
    parted = urls.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    parted = parted.withColumn("weights", model.select("weights").scalar())
    judged = parted.select(
        F.col("key").alias(key),
        "host",
        "path",
        rule.alias("rule"),
        verdict.alias("verdict"),
        _margin(_features(F.col("host"), F.col("path")), F.col("weights")).alias("score"),
    )
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce("verdict", own))
