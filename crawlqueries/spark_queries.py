"""One Spark query per operator or job. Arrays and maps are shown as text, scores to 8 digits."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlqueries import views as V
from crawlspark.fixed_values import MAX_INLINKS
from crawlspark.functions import filters, state, times
from crawlspark.functions.entities import decode_all_entities
from crawlspark.functions.identity import body_text, document_id
from crawlspark.functions.text import gated_text
from crawlspark.operators import dedup, metadata, open_records, records, relevance, stats
from crawlspark.operators import links as link_ops
from crawlspark.plans import dumps
from crawlspark.plans import relevance as relevance_plans
from crawlspark.sources.readers import dump_of_lines, knowledge_base_of_lines, read_stop_words, union_all
from crawlspark.sources.writers import json_lines


def listed(column: str) -> Column:
    return F.array_join(F.col(column), " ").alias(column.split(".")[-1])


def rounded(name: str) -> Column:
    return F.round(name, 8).alias(name)


def _metadata_text(column: str) -> Column:
    entries = F.array_sort(F.transform(F.map_entries(column), lambda entry: F.concat(
        entry["key"], F.lit("="), F.array_join(entry["value"], ","))))
    return F.array_join(entries, ";").alias(column)


def show_dump(dump: DataFrame) -> DataFrame:
    shown = {"extracted_metadata": _metadata_text("extracted_metadata"),
             "crawl_data": F.array_join("crawl_data.inlinks", " ").alias("inlinks")}
    return dump.select(*[shown.get(name, F.col(name)) for name in dump.columns])


# --- statistics ---

def host_url_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.ordered_hosts(stats.host_counts(V.content(spark, sf)))


def crawl_totals(spark, sf):
    return stats.crawl_totals(stats.host_counts(V.content(spark, sf)))


def distinct_urls(spark, sf):
    return stats.distinct_urls(V.recrawled_content(spark, sf))


def url_preview(spark, sf):
    return stats.preview(stats.distinct_urls(V.recrawled_content(spark, sf)), "url")


def distinct_hosts(spark, sf):
    return stats.distinct_hosts(V.recrawled_content(spark, sf))


# --- dumps ---

def cdr_ids(spark, sf):
    usable = V.content(spark, sf).where(filters.is_usable(F.col("content_type"), F.col("content")))
    stamp = times.http_date_text(F.col("http_date"))
    return usable.select("url", document_id(F.col("url"), stamp).alias("doc_id"), stamp.alias("timestamp"))


def cdr_dump_linked(spark, sf):
    return show_dump(dumps.linked_dump(V.content(spark, sf), V.links(spark, sf), V.LABELS, max_inlinks=MAX_INLINKS))


def cdr_dump_linked_left(spark, sf):
    return show_dump(dumps.linked_dump(V.content(spark, sf), V.links(spark, sf), V.LABELS, how="left", max_inlinks=MAX_INLINKS))


def cdr_dump_expanded(spark, sf):
    return show_dump(dumps.linked_dump(V.content(spark, sf), V.links(spark, sf), V.LABELS, how="left", expanded=True,
                                        max_inlinks=MAX_INLINKS))


def cdr_dump_state_time(spark, sf):
    return show_dump(dumps.state_time_dump(V.content(spark, sf), V.state(spark, sf), V.LABELS))


def cdr_dump_unlinked(spark, sf):
    return show_dump(dumps.unlinked_dump(V.content(spark, sf), V.links(spark, sf), V.LABELS))


def cdr_json_roundtrip(spark, sf):
    dump = dumps.unlinked_dump(V.content(spark, sf), V.links(spark, sf), V.LABELS)
    return show_dump(dump_of_lines(json_lines(dump)).select(*dump.columns))


def cdr_json_roundtrip_linked(spark, sf):
    dump = dumps.linked_dump(V.content(spark, sf), V.links(spark, sf), V.LABELS, max_inlinks=MAX_INLINKS)
    return show_dump(dump_of_lines(json_lines(dump)).select(*dump.columns))


def cdr_minimal(spark, sf):
    return records.minimal_records(V.content(spark, sf), V.LABELS)


def _field_texts(column: str) -> Column:
    entries = F.map_entries(column)
    if column.endswith("s"):
        return F.transform(entries, lambda entry: F.concat(
            entry["key"], F.lit("="), F.array_join(entry["value"].cast("array<string>"), ",")))
    return F.transform(entries, lambda entry: F.concat(entry["key"], F.lit("="), entry["value"].cast("string")))


def show_index(index: DataFrame) -> DataFrame:
    fields = [_field_texts(name) for name in index.columns if name.startswith("md_")]
    dynamic = F.array_join(F.array_sort(F.concat(*fields)), ";").alias("dynamic_fields")
    fixed = [column for column in index.columns if not column.startswith("md_") and column != "indexed_at"]
    return index.select(*[listed(name) if name in ("outlinks", "inlinks") else
                          rounded(name) if name == "score" else F.col(name) for name in fixed], dynamic)


def index_dump(spark, sf):
    return show_index(dumps.index_dump(V.content(spark, sf), V.state(spark, sf), V.links(spark, sf), V.CRAWL_ID,
                                       V.LABELS.crawler, max_inlinks=MAX_INLINKS))


def index_dump_left(spark, sf):
    return show_index(dumps.index_dump(V.content(spark, sf), V.state(spark, sf), V.links(spark, sf), V.CRAWL_ID,
                                       V.LABELS.crawler, how="left", max_inlinks=MAX_INLINKS))


def status_and_retry(spark, sf):
    return V.state(spark, sf).select(
        "url",
        state.status_name(F.col("status")).alias("status_name"),
        state.status_code(F.col("metadata")).alias("status_code"),
        times.index_time(F.col("fetch_time")).alias("fetch_timestamp"),
        times.index_time(state.last_modified_millis(F.col("metadata"))).alias("modified_time"),
        state.interval_days(F.col("fetch_interval")).alias("interval_days"))


def fetch_time_text(spark, sf):
    return V.state(spark, sf).select("url", times.plain_time(F.col("fetch_time")).alias("fetched_at"))


# --- images ---

def image_paths(spark, sf):
    return records.image_paths(V.content(spark, sf))


def image_ids(spark, sf):
    return records.image_ids(V.content(spark, sf))


def image_relink(spark, sf):
    pages = V.content(spark, sf)
    dump = dumps.linked_dump(pages, V.links(spark, sf), V.LABELS, how="left", max_inlinks=MAX_INLINKS)
    relinked = records.relink_images(dump, records.latest_times(pages))
    return relinked.select("_id", "url", "obj_parent", F.array_join("crawl_data.inlinks", " ").alias("inlinks"))


def _extra(path: str, kind: str) -> Column:
    return F.try_variant_get("doc", f"$.extra.{path}", kind)


def relink_open_fields(spark, sf):
    pages = V.content(spark, sf)
    dump = dumps.linked_dump(pages, V.links(spark, sf), V.LABELS, how="left", max_inlinks=MAX_INLINKS)
    documents = open_records.open_documents(V.open_lines(dump.withColumn("path", F.lit("file:///dump/part-00000"))))
    relinked = open_records.relink_documents(documents, records.latest_times(pages))
    shown = open_records.document_view(relinked, "_id", "url", "obj_parent", "crawl_data", "n_inlinks")
    return shown.select(
        "_id", "url", "obj_parent", F.array_join("crawl_data.inlinks", " ").alias("inlinks"), "n_inlinks",
        _extra("seen['address of page']", "string").alias("seen"), _extra("sizes[1]", "bigint").alias("n_chars"))


def image_relink_chunks(spark, sf):
    chunks = link_ops.relinked_chunks(V.links(spark, sf), records.latest_times(V.content(spark, sf)), chunk_size=10)
    return chunks.select("url", "n_inlinks", F.explode("inlink_ids").alias("inlink_id"))


# --- deduplication, segments ---

def dedup_index(spark, sf):
    return dedup.dedup_index(V.dump(spark, sf))


def dedup_apply(spark, sf):
    dump = V.dump(spark, sf)
    # The index is a table of its own, like the one the task reads: made once, where a shared folder is set.
    return dedup.apply_dedup_index(dump, dedup.settled_index(dedup.dedup_index(dump))).select("path", "_id", "url", "raw_content")


def dump_open_fields(spark, sf):
    documents = open_records.open_documents(V.open_lines(V.dump(spark, sf)))
    typed = open_records.document_view(documents, "_id", "url", "raw_content")
    kept = open_records.keep_indexed(documents, dedup.settled_index(dedup.dedup_index(typed)))
    return kept.select(
        "path", open_records.document_field(F.col("doc"), "_id").alias("_id"),
        _extra("seen['address of page']", "string").alias("seen"), _extra("sizes[1]", "bigint").alias("n_chars"),
        F.array_join(open_records.field_names(F.col("doc")), " ").alias("field_names"))


def dedup_apply_exact(spark, sf):
    dump = V.dump_with_nulls(spark, sf)
    return dedup.apply_dedup_index(dump, dedup.dedup_index(dump), exact=True).select("path", "_id", "url", "raw_content")


def segment_union(spark, sf):
    return union_all([V.content(spark, sf), V.recrawled_content(spark, sf)]).groupBy("segment").agg(
        F.count("*").alias("n_rows"), F.sum(F.octet_length("content")).alias("n_bytes"))


def segment_merge(spark, sf):
    return dedup.merge_segments(V.recrawled_content(spark, sf), times.http_date_millis(F.col("http_date")))


def dedup_url_text(spark, sf):
    return dedup.one_text_per_url(records.plain_texts(V.recrawled_content(spark, sf)))


# --- text, metadata, links ---

def url_list(spark, sf):
    return records.usable_urls(V.content(spark, sf))


def plain_text(spark, sf):
    return records.plain_texts(V.content(spark, sf)).select("url", "text")


def plain_text_all_entities(spark, sf):
    return records.plain_texts(V.content(spark, sf), decode_all_entities).select("url", "text")


def text_mime_filter(spark, sf):
    return V.content(spark, sf).where(filters.is_text_type(F.col("content_type"))).select("url", "content_type")


def page_filter(spark, sf):
    pages = V.content(spark, sf)
    return pages.where(filters.is_page(F.col("content_type"), F.col("content"))).select("url", "content_type")


def parse_gate(spark, sf):
    text = gated_text(F.col("content_type"), body_text(F.col("content")))
    return V.content(spark, sf).select("url", filters.is_parsable(F.col("content_type")).alias("is_parsable"),
                                       F.length(text).cast("bigint").alias("n_chars"))


def page_outlinks(spark, sf):
    return link_ops.page_outlinks(V.content(spark, sf), web_only=True)


def link_graph(spark, sf):
    return link_ops.link_graph(V.recrawled_content(spark, sf))


def inlink_sets(spark, sf):
    return link_ops.inlink_sets(V.links(spark, sf), MAX_INLINKS).select("url", "parent", listed("inlinks"), "n_inlinks")


def inlink_sets_limited(spark, sf):
    return link_ops.inlink_sets(V.links(spark, sf), max_inlinks=4).select(
        "url", "parent", listed("inlinks"), "n_inlinks")


def inlink_chunks(spark, sf):
    chunks = link_ops.inlink_chunks(V.links(spark, sf), chunk_size=10)
    return chunks.select("url", "n_inlinks", F.explode("inlinks").alias("from_url"))


def page_metadata(spark, sf):
    return metadata.page_metadata(V.content(spark, sf)).select(
        "url", "name", F.array_join("values", ",").alias("value_list"))


def typed_metadata(spark, sf):
    return metadata.typed_metadata(V.content(spark, sf)).select(
        "url", "name", "field", "kind", "is_multiple", F.array_join("values", ",").alias("value_list"))


def field_catalogue(spark, sf):
    catalogue = metadata.field_catalogue(V.content(spark, sf))
    return catalogue.select(*[listed(name) if name == "names" else name for name in catalogue.columns])


# --- relevance ---

def kb_lines(spark, sf):
    return knowledge_base_of_lines(V.knowledge_base_lines(spark, sf))


def kb_term_freq(spark, sf):
    return relevance.kb_terms(V.knowledge_base(spark, sf), read_stop_words(spark))


def kb_idf(spark, sf):
    profile = relevance.kb_profile(V.knowledge_base(spark, sf), read_stop_words(spark))
    return profile.select("term", "df", rounded("idf"))


def kb_profile(spark, sf):
    profile = relevance.kb_profile(V.knowledge_base(spark, sf), read_stop_words(spark))
    return profile.select("term", rounded("weight"))


def kb_magnitude(spark, sf):
    profile = relevance.kb_profile(V.knowledge_base(spark, sf), read_stop_words(spark))
    return relevance.profile_magnitude(profile).select(rounded("magnitude"))


def doc_term_freq(spark, sf):
    return relevance.document_terms(V.table(spark, sf, "documents"), "doc_id")


def page_relevance(spark, sf):
    scores = relevance.page_relevance(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf),
                                      read_stop_words(spark))
    return scores.select("host", "url", rounded("score"))


def doc_similarity(spark, sf):
    return relevance_plans.url_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf)).select(
        "url", rounded("score"))


def host_similarity(spark, sf):
    return relevance_plans.host_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf)).select(
        "host", rounded("score"))


def hashed_similarity(spark, sf):
    return relevance_plans.host_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf),
                                           num_features=1 << 20).select("host", rounded("score"))


def top_domains(spark, sf):
    return relevance_plans.top_domains(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf)).select(
        "host", "url", rounded("score"))


def top_domain_urls(spark, sf):
    scores = relevance_plans.top_domains(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf))
    return relevance.top(scores, "url").select("host", "url", rounded("score"))


def bottom_domain_urls(spark, sf):
    scores = relevance_plans.top_domains(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf))
    return relevance.bottom(scores, "url").select("host", "url", rounded("score"))


def ranked_urls(spark, sf):
    scores = relevance_plans.url_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf))
    return relevance.ranked(scores, "url").select("url", rounded("score"))


def top_urls(spark, sf):
    scores = relevance_plans.url_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf))
    return relevance.top(scores, "url").select("url", rounded("score"))


def bottom_urls(spark, sf):
    scores = relevance_plans.url_similarity(V.recrawled_content(spark, sf), V.knowledge_base(spark, sf))
    return relevance.bottom(scores, "url").select("url", rounded("score"))


QUERIES = {query.__name__: query for query in (
    host_url_counts, crawl_totals, distinct_urls, url_preview, distinct_hosts,
    cdr_ids, cdr_dump_linked, cdr_dump_linked_left, cdr_dump_expanded, cdr_dump_state_time, cdr_dump_unlinked,
    cdr_json_roundtrip, cdr_json_roundtrip_linked, cdr_minimal, index_dump, index_dump_left, status_and_retry, fetch_time_text,
    image_paths, image_ids, image_relink, image_relink_chunks, relink_open_fields,
    dedup_index, dedup_apply, dedup_apply_exact, dump_open_fields, segment_union, segment_merge, dedup_url_text,
    url_list, plain_text, plain_text_all_entities, text_mime_filter, page_filter, parse_gate,
    page_outlinks, link_graph, inlink_sets, inlink_sets_limited, inlink_chunks,
    page_metadata, typed_metadata, field_catalogue,
    kb_lines, kb_term_freq, kb_idf, kb_profile, kb_magnitude, doc_term_freq,
    page_relevance, doc_similarity, host_similarity, hashed_similarity, top_domains, top_urls, bottom_urls,
    top_domain_urls, bottom_domain_urls, ranked_urls,
)}
