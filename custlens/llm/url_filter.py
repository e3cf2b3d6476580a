"""URL filter: host word segmentation and naive Bayes.

Rules come first: a rule fits its host and all subdomains if the path
starts with the rule's path, and the longest fitting rule decides.  The
other URLs are judged by words: concatenated host names are split into
words by a unigram Viterbi search, and multinomial naive Bayes scores the
words of host and path.

The unigram model counts the words of all page texts.  A name only meets
the words that are its own substrings (an equi-join on the substring), so
no dictionary is shipped to the tasks.  Bayes learns from the URLs that a
rule decides, in full, and from a short list of seed words that stand for
``SEED_COUNT`` occurrences each.  Numbers are one token.  Scores are
computed once per distinct host and per distinct path word list, then
looked up.

Defined cases: a null URL or one without ``://`` has empty host and path, no
rule, and the verdict of the class priors; other URLs without a known word
likewise; a tie of equally long rules blocks; repeated rows and null ids
are judged row by row; an empty table gives no rows; columns named like
an output are replaced.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, fresh_name, lookup, ship_by_value

ship_by_value(__name__)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_WORD = 24             # letters of a word that the segmentation may use
SMOOTH = 1.0
SEED_COUNT = 50.0
# Words that mark a class from the start.
SEED_BLOCK = ("spam pills casino viagra porn xxx adult poker betting loan loans replica escort malware phishing "
              "warez crack torrent cheap farm clickbait lottery").split()
SEED_ALLOW = "docs wiki library university museum school research science health weather history".split()

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def host_of(url: str) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: str, path: str, rules) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule, null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block")):      # the last fitting one wins
        h, _, p = rule.partition("/")
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith("/" + p)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def segment(name: str, words: list[str], costs: list[float]) -> list[str]:
    """Viterbi: the split of ``name`` into parts of least total cost.  A part that
    is no known word costs more than any word, and more by the letter; ties to
    the longer last part."""
    by_word = dict(zip(words, costs))
    unknown, letter = max([10.0, *costs]) + 1.0, math.log(26.0)
    best, back = [0.0] + [math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - MAX_WORD), end):
            w = name[start:end]
            c = best[start] + by_word.get(w, unknown + letter * len(w))
            if c < best[end]:
                best[end], back[end] = c, start
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, n) over the texts of all pages."""
    text = F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&\w+;", " ")
    words = pages.select(F.explode(F.split(F.lower(text), r"[^\p{L}]+")).alias("word"))
    return words.where((F.length("word") > 0) & (F.length("word") <= MAX_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def segment_names(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name) -> (name, words) by the unigram model ``counts``."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    subs = F.flatten(F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.transform(
        F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("name") - i + 1)), lambda k: F.col("name").substr(i, k))))
    seeds = F.array(*[F.lit(w) for w in (*SEED_BLOCK, *SEED_ALLOW)])
    pairs = names.where(F.length("name") > 0).select("name", F.explode(F.array_distinct(subs)).alias("word"))
    known = pairs.join(counts, "word", "left").withColumn(
        "n", F.coalesce("n", F.lit(0)) + F.when(F.array_contains(seeds, F.col("word")), F.lit(SEED_COUNT)).otherwise(F.lit(0.0)))
    found = known.where("n > 0").groupBy("name").agg(
        F.collect_list("word").alias("w"), F.collect_list(-F.log(F.col("n") / F.lit(float(total)))).alias("c"))
    found = names.where(F.length("name") > 0).join(found, "name", "left")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("words", T.ArrayType(T.StringType()))])

    def run(batches):
        for b in batches:
            n, w, c = (b.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [pa.array(n, pa.string()), pa.array([segment(a, x or [], y or []) for a, x, y in zip(n, w, c)], pa.list_(pa.string()))],
                names=schema.names)

    return found.select("name", "w", "c").mapInArrow(run, schema)


def path_words(path: str) -> Column:
    words = F.split(F.lower(F.col(path)), r"[^\p{L}\p{N}]+")
    words = F.filter(words, lambda w: w != "")
    return F.transform(words, lambda w: F.when(w.rlike(r"\p{N}"), F.lit("<number>")).otherwise(w))


def judge(pages: DataFrame, rules=RULES, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` plus host, path, rule, verdict and score (log odds of block by the
    words; null where a rule decides)."""
    new = {"host", "path", "rule", "verdict", "score"}
    keep = [c for c in pages.columns if c.lower() not in new]
    p = pages.select(F.col(f"`{url_col}`").alias("__url")).select(host_of("__url").alias("host"), path_of("__url").alias("path"))
    says = fresh_name(pages, "__says")
    rule, verdict = rule_of("host", "path", rules)
    p = p.select("host", path_words("path").alias("pw"), verdict.alias("says"))

    # distinct hosts -> words
    hosts = cut_lineage(p.groupBy("host").agg(
        F.sum(F.when(F.col("says") == "block", 1).otherwise(0)).alias("block"),
        F.sum(F.when(F.col("says") == "allow", 1).otherwise(0)).alias("allow")))
    parts = hosts.select("host", F.explode(F.filter(F.split("host", r"[^\p{L}]+"), lambda x: x != "")).alias("name"))
    counts = cut_lineage(word_counts(pages.select(F.col(f"`{html_col}`").alias("html")), "html"))
    split = segment_names(parts.select("name").distinct(), counts)
    host_words = cut_lineage(parts.join(split, "name").select("host", F.explode("words").alias("word")))
    # distinct lists of path words
    paths = cut_lineage(p.groupBy("pw").agg(
        F.sum(F.when(F.col("says") == "block", 1).otherwise(0)).alias("block"),
        F.sum(F.when(F.col("says") == "allow", 1).otherwise(0)).alias("allow")))
    path_word = paths.select("pw", F.explode("pw").alias("word"))

    # multinomial naive Bayes over all URLs that a rule decides, plus the seeds
    seen = (host_words.join(hosts, "host").select("word", "block", "allow")
            .unionByName(paths.select(F.explode("pw").alias("word"), "block", "allow")))
    spark = pages.sparkSession
    seeds = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(w).alias("word"), F.lit(b).alias("block"), F.lit(a).alias("allow"))
                                                      for ws, b, a in ((SEED_BLOCK, SEED_COUNT, 0.0), (SEED_ALLOW, 0.0, SEED_COUNT)) for w in ws])).alias("s")).select("s.*")
    by_word = cut_lineage(seen.unionByName(seeds).groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")))
    t = by_word.agg(F.sum("block"), F.sum("allow"), F.count(F.lit(1))).first()
    n_block, n_allow = (float(x or 0) + SMOOTH * float(t[2]) for x in t[:2])
    weight = F.log((F.col("block") + SMOOTH) / n_block) - F.log((F.col("allow") + SMOOTH) / n_allow)
    weights = by_word.where("block + allow > 0").select("word", weight.alias("weight"))   # words of both classes unseen say nothing
    docs = hosts.agg(F.sum("block"), F.sum("allow")).first()
    prior = math.log((float(docs[0] or 0) + 1.0) / (float(docs[1] or 0) + 1.0))
    host_score = cut_lineage(host_words.join(weights, "word").groupBy("host").agg(F.sum("weight").alias("__host_score")))
    path_score = cut_lineage(path_word.join(weights, "word").groupBy("pw").agg(F.sum("weight").alias("__path_score")))

    out = pages.select([F.col(f"`{c}`") for c in keep] + [F.col(f"`{url_col}`").alias("__url")])
    out = out.withColumns({"host": host_of("__url"), "path": path_of("__url")})
    rule, verdict = rule_of("host", "path", rules)
    out = out.withColumns({"rule": rule, says: verdict, "__pw": path_words("path")})
    out = lookup(lookup(out, host_score, "host"), path_score.withColumnRenamed("pw", "__pw"), "__pw")
    score = F.lit(prior) + F.coalesce("__host_score", F.lit(0.0)) + F.coalesce("__path_score", F.lit(0.0))
    return out.withColumn("score", F.when(F.col(says).isNull(), score)).withColumn(
        "verdict", F.coalesce(F.col(says), F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))).select(
        *keep, "host", "path", "rule", "verdict", "score")
