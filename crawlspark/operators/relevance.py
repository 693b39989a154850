"""Similarity of pages to a knowledge base of example texts.

A knowledge base is collapsed into one row per term (its profile). A page's
score then needs one join on the term and two sums, whatever the number of
knowledge-base texts; pages and knowledge-base texts are never paired.

Scores are sums of doubles, whose last digits depend on the order of addition.
Rankings therefore compare scores rounded to `SCORE_DIGITS`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions.filters import is_parsable, is_text_type
from crawlspark.functions.identity import body_text
from crawlspark.functions.text import is_markup, markup_to_text, tokens
from crawlspark.functions.urls import host
from crawlspark.operators.joins import lookup_join, settled, skew_safe_join

SCORE_DIGITS = 10
TEXT_BYTES_PER_TASK = 4 << 20


def term_bucket(term: Column, num_features: int) -> Column:
    """Bucket of a term: the first 60 bits of its SHA-256 modulo the number of buckets."""
    return F.pmod(F.conv(F.substring(F.sha2(term, 256), 1, 15), 16, 10).cast("bigint"), F.lit(num_features))


def term_counts(texts: DataFrame, *keys: str, lower: bool = False, num_features: int | None = None) -> DataFrame:
    """`term`, `tf` per key of a table with a `text` column.

    A text without tokens yields one row with a null term and a tf of 0, so its
    key is not lost. `num_features` replaces terms by hash buckets.
    """
    text = F.lower(F.col("text")) if lower else F.col("text")
    term = F.col("term")
    if num_features is not None:
        term = F.when(term.isNotNull(), term_bucket(term, num_features))
    return (
        texts.select(*keys, F.explode_outer(tokens(text)).alias("term"))
        .select(*keys, term.alias("term"))
        .groupBy(*keys, "term").agg(F.count("term").alias("tf"))
    )


def counted_terms(words: Column) -> Column:
    """Distinct words of a list and how often each occurs, as `(term, tf)` entries. The list is sorted once."""
    def counted(ordered: Column) -> Column:
        starts = F.filter(F.transform(ordered, lambda word, place: F.when(
            (place == 0) | (word != F.get(ordered, place - 1)), place)), lambda place: place.isNotNull())
        return F.get(F.transform(F.array(starts), lambda first: F.transform(first, lambda place, n: F.struct(
            F.get(ordered, place).alias("term"),
            (F.coalesce(F.get(first, n + 1), F.size(ordered)) - place).cast("bigint").alias("tf")))), F.lit(0))

    # One-element transforms give the sorted list and the starts a name, so that each is made once.
    return F.get(F.transform(F.array(F.array_sort(words)), counted), F.lit(0))


def text_terms(texts: DataFrame, *keys: str, lower: bool = False, num_features: int | None = None) -> DataFrame:
    """`term_counts` of every row on its own: counting stays within the text, so no term is shuffled or held beside others."""
    words = tokens(F.lower(F.col("text")) if lower else F.col("text"))
    if num_features is not None:
        words = F.transform(words, lambda word: term_bucket(word, num_features))
    found = texts.select(*keys, F.inline_outer(counted_terms(words)))
    return found.select(*keys, "term", F.coalesce("tf", F.lit(0).cast("bigint")).alias("tf"))


def document_terms(texts: DataFrame, key: str) -> DataFrame:
    """`term`, `tf` per text. Texts that share a key, or have none, count as one.

    The texts are shuffled once by key; counting then stays within that
    partitioning, so the much longer list of terms is never shuffled. Their bytes are summed first
    (one job), so that a task holds the terms of about `TEXT_BYTES_PER_TASK` however many texts there are.
    """
    size = texts.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TEXT_BYTES_PER_TASK))
    return term_counts(texts.select(key, "text").repartition(tasks, key), key).where(F.col("term").isNotNull())


# --- knowledge base: term frequency x inverse document frequency, lower case, without stop words ---

def kb_terms(kb: DataFrame, stop_words: DataFrame) -> DataFrame:
    """`term`, `tf` (occurrences), `df` (distinct urls) over the knowledge base."""
    counted = (
        term_counts(kb.select("kb_url", F.col("kb_text").alias("text")), "kb_url", lower=True)
        .where(F.col("term").isNotNull())
        .groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    )
    return counted.join(stop_words.select(F.lower(F.trim("word")).alias("term")).distinct(), "term", "left_anti")


def kb_profile(kb: DataFrame, stop_words: DataFrame) -> DataFrame:
    """`term`, `tf`, `df`, `idf` = ln(N / df), `weight` = tf * idf."""
    total = kb.agg(F.count("*")).scalar()
    return kb_terms(kb, stop_words).withColumn("idf", F.ln(total / F.col("df"))).withColumn(
        "weight", F.col("tf") * F.col("idf"))


def profile_magnitude(profile: DataFrame) -> DataFrame:
    """One row, `magnitude`: the Euclidean length of the profile's weights."""
    return profile.agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("magnitude"))


# --- knowledge base: mean of unit vectors, smoothed idf, case kept, stop words kept ---

def _distinct_texts(kb: DataFrame) -> DataFrame:
    # Equal texts have equal vectors: keep one with its multiplicity.
    return kb.groupBy(F.sha2("kb_text", 256).alias("kb_key")).agg(
        F.first("kb_text").alias("text"), F.count("*").alias("copies"))


def _kb_weights(kb: DataFrame, num_features: int | None) -> DataFrame:
    counts = term_counts(_distinct_texts(kb), "kb_key", "copies", num_features=num_features).where(
        F.col("term").isNotNull())
    total = kb.agg(F.count("*")).scalar()
    idf = counts.groupBy("term").agg(F.sum("copies").alias("df")).select(
        "term", F.ln((total + 1) / (F.col("df") + 1)).alias("idf"))
    return skew_safe_join(counts, idf, ["term"]).withColumn("weight", F.col("tf") * F.col("idf"))


def mean_vector_profile(kb: DataFrame, num_features: int | None = None) -> DataFrame:
    """`term`, `doc_factor` (idf), `weight`: the mean of the knowledge-base unit vectors.

    The mean over the knowledge base of cosine(page, text) equals the page's
    unit vector times this mean, since the cosine is linear in the unit vector.
    Texts without weight add nothing but are counted.
    """
    weights = _kb_weights(kb, num_features)
    total = kb.agg(F.count("*")).scalar()
    norms = weights.groupBy("kb_key").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    unit = skew_safe_join(weights, norms, ["kb_key"])
    share = F.when(F.col("norm") > 0, F.col("copies") * F.col("weight") / F.col("norm")).otherwise(0.0)
    return unit.groupBy("term").agg(
        F.max("idf").alias("doc_factor"), (F.sum(share) / total).alias("weight"))


def pooled_profile(kb: DataFrame, num_features: int | None = None) -> DataFrame:
    """`term`, `doc_factor` (idf), `weight`: tf x idf of the whole knowledge base as one text."""
    weights = _kb_weights(kb, num_features)
    return weights.groupBy("term").agg(
        F.max("idf").alias("doc_factor"), F.sum(F.col("copies") * F.col("weight")).alias("weight"))


def unseen_factor(kb: DataFrame) -> Column:
    """Smoothed idf of a term that occurs nowhere in the knowledge base."""
    return F.ln((kb.agg(F.count("*")).scalar() + 1).cast("double"))


# --- scoring ---

def score_texts(texts: DataFrame, key: str, profile: DataFrame, *, lower: bool = False,
                unseen: Column | None = None, magnitude: Column | None = None,
                num_features: int | None = None) -> DataFrame:
    """`key`, `score`: cosine of each text (unique per key) with the profile; 0 without a common term.

    A page term weighs tf times the profile's `doc_factor` (`unseen` for terms
    outside the profile). Without `doc_factor` it weighs tf. `magnitude` divides
    the score by the profile's length. The length of a page covers all its terms.
    """
    if unseen is None:
        unseen = F.lit(1.0)
    if "doc_factor" not in profile.columns:
        profile = profile.withColumn("doc_factor", F.lit(1.0))
    counts = text_terms(texts, key, lower=lower, num_features=num_features)
    known = lookup_join(counts, profile.select("term", "doc_factor", "weight"), ["term"], "left")
    weight = F.col("tf") * F.coalesce(F.col("doc_factor"), unseen)
    sums = (
        known.select(key, weight.alias("w"), F.coalesce("weight", F.lit(0.0)).alias("p"))
        .groupBy(key)
        .agg(F.sum(F.col("w") * F.col("p")).alias("dot"), F.sum(F.col("w") * F.col("w")).alias("square"))
    )
    length = F.sqrt("square")
    if magnitude is not None:
        length = length * magnitude
    return sums.select(key, F.when(F.col("dot") != 0, F.col("dot") / length).otherwise(0.0).alias("score"))


def page_relevance(content: DataFrame, kb: DataFrame, stop_words: DataFrame) -> DataFrame:
    """`host`, `url`, `score` for every text page: term frequencies against the tf-idf profile.

    Every page row is scored, copies included. Copies of one body are scored
    once: distinct bodies are shuffled by hash, all term work stays within that
    partitioning, and the scores are joined back to the rows.
    """
    profile = settled(kb_profile(kb, stop_words).select("term", "weight"))
    kind = F.col("content_type")
    body = F.when(is_parsable(kind), body_text(F.col("content"))).otherwise("")
    pages = content.where(is_text_type(kind)).select("url", kind, F.coalesce(body, F.lit("")).alias("body"))
    pages = pages.withColumn("marked", is_markup(F.col("body"), kind))
    # Never null, so the join below adds no null check that would hash every body again.
    keyed = pages.withColumn("body_key", F.coalesce(
        F.concat(F.sha2("body", 256), F.col("marked").cast("string")), F.lit("")))
    # Copies are told apart by hash first; text is taken from one of each.
    bodies = keyed.groupBy("body_key").agg(F.first("body").alias("body"), F.first("marked").alias("marked"))
    texts = bodies.select("body_key", F.when(F.col("marked"), markup_to_text(F.col("body"))).otherwise(
        F.col("body")).alias("text"))
    scores = score_texts(texts, "body_key", profile, lower=True,
                         magnitude=profile_magnitude(profile).scalar())
    rows = keyed.select("url", "body_key")
    return skew_safe_join(rows, scores, ["body_key"]).select(host(F.col("url")).alias("host"), "url", "score")


def mean_similarity(texts: DataFrame, kb: DataFrame, key: str = "url",
                    num_features: int | None = None) -> DataFrame:
    """`key`, `score`: mean cosine of each text with all knowledge-base texts."""
    profile = settled(mean_vector_profile(kb, num_features))
    return score_texts(texts, key, profile, unseen=unseen_factor(kb), num_features=num_features)


def pooled_similarity(texts: DataFrame, kb: DataFrame, key: str = "url",
                      num_features: int | None = None) -> DataFrame:
    """`key`, `score`: cosine of each text with the pooled knowledge base."""
    profile = settled(pooled_profile(kb, num_features))
    return score_texts(texts, key, profile, unseen=unseen_factor(kb),
                       magnitude=profile_magnitude(profile).scalar(), num_features=num_features)


def host_means(scores: DataFrame) -> DataFrame:
    """`host`, `score`: mean score of a host's URLs."""
    return scores.groupBy(host(F.col("url")).alias("host")).agg(F.avg("score").alias("score"))


def _in_order(scores: DataFrame, name: str) -> DataFrame:
    return scores.orderBy(F.desc(F.round("score", SCORE_DIGITS)), name)


def ranked(scores: DataFrame, name: str) -> DataFrame:
    """Rows by score, largest first; equal scores by name. Sorting reads its input twice, so scores are made once before."""
    return _in_order(settled(scores), name)


def top(scores: DataFrame, name: str, k: int = 20) -> DataFrame:
    """The k best rows of the ranking."""
    return _in_order(scores, name).limit(k)


def bottom(scores: DataFrame, name: str, k: int = 20) -> DataFrame:
    """The last k rows of the ranking, worst first."""
    return scores.orderBy(F.round("score", SCORE_DIGITS), F.desc(name)).limit(k)
