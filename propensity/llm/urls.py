"""URL filters by a ratio of two character language models, in DataFrame expressions alone.

Rules (host and path prefixes) judge the URLs they fit; all others are judged by text. URLs that rules accept and URLs that
rules reject train one Markov model of characters each. The order is variable: the probability of a character is
mixed from contexts of ``ORDER`` characters down to none (Witten-Bell: a context counts for itself as often as it was seen,
and gives way to the shorter one as often as it was followed by something new), ending in a uniform distribution. A URL's score is the
log-likelihood difference of the two models, divided by its characters; the cut between accept and reject is calibrated on
a fifth of the ruled URLs that the models do not see.

Texts are cut into host and rest, each distinct part is scored once, and a part's statistics are shared by all URLs that
have it: a host with a third of all pages is one row of the join. N-grams are counted map-side first, and the models meet
each distinct n-gram once. Its score meets the parts with a salt on both sides, so an n-gram that every part has is spread over tasks.

Defined cases: a null URL, or one without ``://``, has an empty host and path, so no rule fits it; its text is scored as it is (null as
empty, which scores 0). A host or path that is null or empty fits only rules whose host and path prefix allow that. Repeated rows are judged one by
one; without ruled URLs of both kinds all scores are 0 and the cut is 0, which accepts. Scores equal to the cut accept. Long URLs are
scored whole; the time of a URL grows with the square of its length, as the JVM finds characters by counting them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.session import materialize

#: Verdict, host and path prefix.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4
ALPHABET = 256
SALTS = 8
STEPS = 400  # edges of the calibration grid
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty without ``://``."""
    after = F.when(url.contains("://"), F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        rule = F.when(fits, domain + prefix).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _characters(text: str) -> str:
    """(gram, next) of every place of a text: the up to ORDER characters before it and the character itself."""
    return (
        f"transform(sequence(1, length({text})), i -> struct("
        f"substring({text}, greatest(1, i - {ORDER}), least(i - 1, {ORDER})) AS before, substring({text}, i, 1) AS next))"
    )


def _contexts(before: str) -> str:
    """The contexts of a place from the longest to the empty one."""
    return f"transform(sequence(0, length({before})), k -> substring({before}, k + 1))"


def segments(urls: DataFrame) -> DataFrame:
    """``urls`` (with a column url) with ``head`` and ``tail``: the host and what follows it, as the models see them.

    Every part begins with the sign that opens it, so that its first characters have a context.
    """
    url = F.coalesce("url", F.lit(""))
    text = F.when(url.contains("://"), F.expr("substring(coalesce(url, ''), locate('://', coalesce(url, '')) + 3)")).otherwise(url)
    head = F.translate(F.regexp_extract(text, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    return urls.withColumn("head", F.concat(F.lit("^"), head)).withColumn("tail", F.concat(F.lit("$"), F.regexp_replace(text, r"(?s)^[^/?#]*", "")))


def distinct_parts(urls: DataFrame, *by: str) -> DataFrame:
    """(part, ...by, n): every distinct head and tail with the number of URLs that have it."""
    return urls.select(*by, F.explode(F.array("head", "tail")).alias("part")).groupBy("part", *by).agg(F.count("*").alias("n"))


def trained(urls: DataFrame) -> DataFrame:
    """(gram, chances): for every context, the two models' counts of its next characters.

    ``urls`` has head, tail and ``accepted`` (boolean). The row of a context holds, for each model, how often it was seen,
    how many characters followed it, and a map of their counts; at most ``ALPHABET`` entries or those that occur.
    """
    seen = (
        distinct_parts(urls, "accepted")
        .select("accepted", "n", F.explode(F.expr(_characters("part"))).alias("c"))
        .select("accepted", "n", F.col("c.next").alias("next"), F.explode(F.expr(_contexts("c.before"))).alias("context"))
        .groupBy("context", "next")
        .agg(
            F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))).alias("bad"),
        )
    )
    return seen.groupBy("context").agg(
        F.map_from_entries(F.collect_list(F.struct("next", F.struct(F.col("good").cast("double").alias("good"), F.col("bad").cast("double").alias("bad"))))).alias("follow"),
        *[F.sum(c).cast("double").alias(f"{c}_n") for c in ("good", "bad")],
        *[F.sum(F.when(F.col(c) > 0, 1.0).otherwise(0.0)).alias(f"{c}_kinds") for c in ("good", "bad")],
    )


def gram_scores(grams: DataFrame, model: DataFrame) -> DataFrame:
    """(before, next, llr): the log-likelihood difference of every distinct gram."""
    found = (
        grams.withColumn("context", F.explode(F.expr(_contexts("before"))))
        .join(model, "context")
        .select(
            "before", "next",
            F.length("context").alias("k"),
            *[F.coalesce(F.element_at("follow", F.col("next"))[c], F.lit(0.0)).alias(c) for c in ("good", "bad")],
            "good_n", "bad_n", "good_kinds", "bad_kinds",
        )
        .groupBy("before", "next")
        .agg(F.array_sort(F.collect_list(F.struct("k", "good", "good_n", "good_kinds", "bad", "bad_n", "bad_kinds"))).alias("levels"))
    )

    def chance(name: str) -> Column:
        return F.aggregate(
            "levels",
            F.lit(1.0 / ALPHABET),
            lambda lower, x: F.when(x[f"{name}_n"] > 0, (x[name] + x[f"{name}_kinds"] * lower) / (x[f"{name}_n"] + x[f"{name}_kinds"])).otherwise(lower),
        )

    return found.select("before", "next", (F.log(chance("good")) - F.log(chance("bad"))).alias("llr"))


def scored_parts(part: DataFrame, model: DataFrame) -> DataFrame:
    """(part, llr, n): the log-likelihood difference of every distinct part and its number of characters."""
    tasks = int(part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a part has a number, so that its many places do not carry its text
    numbered = materialize(part.repartition(tasks, "part").withColumn("of", F.monotonically_increasing_id()))
    places = numbered.select("of", F.explode(F.expr(_characters("part"))).alias("c")).select("of", "c.before", "c.next")
    known = gram_scores(places.select("before", "next").distinct(), model)
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sums = (
        places.withColumn("salt", F.pmod(F.xxhash64("of"), F.lit(SALTS)).cast("int"))
        .join(salted, ["before", "next", "salt"])
        .groupBy("of")
        .agg(F.sum("llr").alias("llr"), F.count("*").alias("n"))
    )
    return numbered.join(sums, "of").select("part", "llr", "n")


def scored(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``urls`` (with head and tail) with ``score``, the difference per character; 0 where the model knows nothing."""
    part = scored_parts(distinct_parts(urls).select("part"), model)
    out = urls
    for side in ("head", "tail"):
        out = out.join(part.select(F.col("part").alias(side), F.col("llr").alias(f"{side}_llr"), F.col("n").alias(f"{side}_n")), side, "left")
    total, n = (F.coalesce(f"head_{x}", F.lit(0)) + F.coalesce(f"tail_{x}", F.lit(0)) for x in ("llr", "n"))
    # the two opening signs are not characters of the URL and say nothing
    return out.withColumn("score", F.coalesce(total / F.greatest(n - 2, F.lit(1)), F.lit(0.0))).drop("head_llr", "head_n", "tail_llr", "tail_n")


def calibrated_cut(held: DataFrame) -> float:
    """The cut with the best balanced accuracy on held-out URLs (score, accepted); the middle of the best range."""
    edge = F.floor(F.greatest(F.least(F.col("score"), F.lit(2.0)), F.lit(-2.0)) * (STEPS // 4)).cast("int")
    rows = held.groupBy(edge.alias("edge")).agg(F.sum(F.col("accepted").cast("int")).alias("good"), F.count("*").alias("n")).collect()
    good, bad = sum(r.good for r in rows), sum(r.n - r.good for r in rows)
    if not good or not bad:
        return 0.0
    best, cuts = -1.0, [0]
    for cut in range(-STEPS // 2, STEPS // 2 + 1):
        right = sum(r.good for r in rows if r.edge >= cut) / good + sum(r.n - r.good for r in rows if r.edge < cut) / bad
        if right > best + 1e-12:
            best, cuts = right, [cut]
        elif right > best - 1e-12:
            cuts.append(cut)
    return cuts[len(cuts) // 2] / (STEPS // 4)


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` (columns kept, but for those called like an added one) with host, path, rule, score and verdict."""
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "score", "verdict")]
    # a row travels in one struct, so no name of the steps between meets one of its columns
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    host, path = parts(F.col("url"))
    kept = segments(pages.select("url", whole.alias("whole")).withColumn("host", host).withColumn("path", path))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    kept = kept.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(5)))
    ruled = kept.where(F.col("ruled").isNotNull()).withColumn("accepted", F.col("ruled") == "allow").select("head", "tail", "fold", "accepted")
    model = materialize(trained(ruled.where("fold <> 0")))
    both = model.where("context = ''").select("good_n", "bad_n").first()
    if both is None or not both.good_n or not both.bad_n:
        model = model.limit(0)
    everything = materialize(scored(kept.drop("url"), model))
    cut = calibrated_cut(everything.where("fold = 0 AND ruled IS NOT NULL").select("score", (F.col("ruled") == "allow").alias("accepted")))
    by_text = F.when(F.col("score") >= cut, "allow").otherwise("block")
    columns = [F.col(f"whole.c{i}").alias(c) for i, c in enumerate(own)]
    return everything.select(*columns, "host", "path", "rule", "score", F.coalesce("ruled", by_text).alias("verdict"))


def op5_urls(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judged(pages).select("page_id", "host", "path", "rule", "verdict", "score")
