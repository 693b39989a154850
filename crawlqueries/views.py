"""The given tables seen as a crawl. Every view covers its tables whole.

- `pages` are web pages, `documents` plain-text files (copies share an address),
  `part` rows product images, `orders` JSON order pages, `customer` rows HTML
  account pages (empty for overdrawn accounts), `supplier` rows untyped content;
- `lineitem` says which order page shows which product image, `orders` which
  order page links to which account page;
- `benchmark` is the knowledge base.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.fixed_values import KB_DELIMITER, LAST_MODIFIED_KEY, PROTOCOL_CODE_KEY
from crawlspark.functions.times import clock
from crawlspark.operators.records import RunLabels, dump_records
from crawlspark.sources.readers import union_all

LABELS = RunLabels(doc_type="webpage", crawler="crawler 1.0", team="team")
CRAWL_ID = "crawl-1"
OPENINGS = ("<!-- note -->", "\ufeff", "<section>", "word ", "<ul><li>one</li></ul>")
START = 1_472_580_000  # seconds: 30 Aug 2016 18:00:00 GMT


# Declared, so that opening a table starts no job.
SCHEMAS = {
    "pages": "page_id bigint, url string, html string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "benchmark": "item_id bigint, text string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table of short rows dealt out by its key: a file of few row groups is read by few tasks, whatever its size, and
    all that is made of its rows would be made, written and sorted in those."""
    return table(spark, sf_dir, name).repartition(key)


def _http_date(seconds: Column) -> Column:
    seconds = seconds.cast("bigint")
    day = F.date_from_unix_date(F.floor(seconds / 86_400).cast("int"))
    return F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" "), clock(seconds * 1000), F.lit(" GMT"))


def _part_url(key: Column) -> Column:
    return F.concat(F.lit("http://img.shop.example.com/part/"), key.cast("string"), F.lit(".jpg"))


def _shop_url(kind: str, key: Column) -> Column:
    return F.concat(F.lit(f"http://www.shop.example.com/{kind}/"), key.cast("string"))


def _web(spark: SparkSession, sf_dir: str, segment: str = "web", delay: int = 0) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        F.lit(segment).alias("segment"),
        url,
        F.when(url.endswith("/"), "application/xhtml+xml")
        .when(url.contains("?page="), "text/html; charset=utf-8")
        .otherwise("text/html").alias("content_type"),
        F.col("html").alias("content"),
        F.when(url.contains("utm_source"), "not a date")
        .otherwise(_http_date(F.lit(START + delay) + F.col("page_id") * 61)).alias("http_date"),
    )


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.lit("files").alias("segment"),
        F.concat(F.lit("http://www."), "source", F.lit(".example.org/"), "lang", F.lit("/"),
                 F.col("n_chars").cast("string"), F.lit(".txt")).alias("url"),
        F.lit("text/plain").alias("content_type"),
        F.col("text").alias("content"),
        _http_date(F.lit(START) + F.col("doc_id") * 37).alias("http_date"),
    )


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(spark, sf_dir, "part", "p_partkey").select(
        F.lit("shop").alias("segment"),
        _part_url(F.col("p_partkey")).alias("url"),
        F.lit("image/jpeg").alias("content_type"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string")).alias("content"),
        _http_date(F.lit(START) + F.col("p_size") * 86_400).alias("http_date"),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(spark, sf_dir, "orders", "o_orderkey").select(
        F.lit("shop").alias("segment"),
        _shop_url("order", F.col("o_orderkey")).alias("url"),
        F.lit("application/json").alias("content_type"),
        F.format_string(
            '{"order": %d, "customer": %d, "status": "%s", "priority": "%s", "note": "prices in cents, see terms"}',
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("content"),
        _http_date(F.lit(START) + F.col("o_orderkey") * 7).alias("http_date"),
    )


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(
        F.lit("<html><head><title>"), F.col("c_name"),
        F.lit('</title><meta name="Nation Key" content="'), F.col("c_nationkey").cast("string"),
        F.lit('"><meta name="Account Balance" content="'), F.col("c_acctbal").cast("string"),
        F.lit('"><meta name="code" content="'), F.col("c_nationkey").cast("string"),
        F.lit('"><meta name="code" content="'), F.col("c_mktsegment"),
        F.lit('"><meta name="code" content="'), F.col("c_custkey").cast("string"),
        F.lit('"><meta name="Large" content="'), (F.col("c_acctbal") > 5000).cast("string"),
        F.lit('"></head><body><a href="/nation/'), F.col("c_nationkey").cast("string"),
        F.lit('">nation</a> <a href="../segment/'), F.col("c_mktsegment"),
        F.lit('">segment</a><p>'), F.col("c_name"), F.lit(" of "), F.col("c_mktsegment"),
        F.lit("</p></body></html>"))
    return _spread(spark, sf_dir, "customer", "c_custkey").select(
        F.lit("shop").alias("segment"),
        _shop_url("customer", F.col("c_custkey")).alias("url"),
        F.lit("text/html").alias("content_type"),
        F.when(F.col("c_acctbal") < 0, "").otherwise(html).alias("content"),
        F.lit(None).cast("string").alias("http_date"),
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that open with something other than a doctype."""
    opening = F.element_at(F.array(*map(F.lit, OPENINGS)), F.col("n_regionkey").cast("int") % len(OPENINGS) + 1)
    return table(spark, sf_dir, "nation").select(
        F.lit("shop").alias("segment"),
        _shop_url("nation", F.col("n_nationkey")).alias("url"),
        F.lit("text/html").alias("content_type"),
        F.concat(opening, F.lit("<title>"), F.col("n_name"), F.lit('</title><p>caf&eacute; &#8217;&#x2014; in region '),
                 F.col("n_regionkey").cast("string"), F.lit('</p><a href="/region/'),
                 F.col("n_regionkey").cast("string"), F.lit('">region</a>')).alias("content"),
        F.lit(None).cast("string").alias("http_date"),
    )


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(spark, sf_dir, "supplier", "s_suppkey").select(
        F.lit("shop").alias("segment"),
        _shop_url("supplier", F.col("s_suppkey")).alias("url"),
        F.lit(None).cast("string").alias("content_type"),
        F.col("s_name").alias("content"),
        F.lit(None).cast("string").alias("http_date"),
    )


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segment, url, content_type, content, http_date."""
    parts = (_web, _files, _images, _orders, _accounts, _suppliers, _nations)
    return union_all([part(spark, sf_dir) for part in parts])


def recrawled_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl, and all web pages fetched again a day later."""
    return union_all([content(spark, sf_dir), _web(spark, sf_dir, "web2", 86_400)])


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """to_url, from_url."""
    shown = table(spark, sf_dir, "lineitem").select(
        _part_url(F.col("l_partkey")).alias("to_url"), _shop_url("order", F.col("l_orderkey")).alias("from_url"))
    placed = table(spark, sf_dir, "orders").select(
        _shop_url("customer", F.col("o_custkey")).alias("to_url"),
        _shop_url("order", F.col("o_orderkey")).alias("from_url"))
    return union_all([shown, placed])


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, status, fetch_time, score, fetch_interval, retries, metadata."""
    url = F.col("url")

    def metadata(modified: Column, code: Column) -> Column:
        pairs = F.array(F.struct(F.lit(LAST_MODIFIED_KEY).alias("k"), modified.alias("v")),
                        F.struct(F.lit(PROTOCOL_CODE_KEY).alias("k"), code.alias("v")))
        return F.map_from_entries(F.filter(pairs, lambda pair: pair["v"].isNotNull())).alias("metadata")

    secure = url.startswith("https")
    web = table(spark, sf_dir, "pages").select(
        url,
        F.when(secure, "db_fetched").otherwise("db_redir_temp").alias("status"),
        (F.lit(START * 1000 + 123) + F.col("page_id") * 61_000).alias("fetch_time"),
        (1.0 / (1 + F.col("page_id"))).cast("double").alias("score"),
        F.when(url.endswith("#top"), 129_600).otherwise(2_592_000).cast("int").alias("fetch_interval"),
        F.when(url.contains("?"), 2).otherwise(0).cast("int").alias("retries"),
        metadata(F.when(url.endswith("/"), F.lit("success(1)")).otherwise(F.concat(
            F.lit("success(1), lastModified="), (F.lit(1_472_000_000_000) + F.col("page_id") * 1000).cast("string"))),
            F.when(secure, F.lit("200"))),
    )
    images = table(spark, sf_dir, "part").select(
        _part_url(F.col("p_partkey")).alias("url"),
        F.lit("db_fetched").alias("status"),
        (F.lit(START * 1000) + F.col("p_partkey") * 1000).alias("fetch_time"),
        (F.col("p_retailprice") / 1000).alias("score"),
        (F.col("p_size") * 7200).cast("int").alias("fetch_interval"),
        F.lit(0).alias("retries"),
        metadata(F.lit("lastModified=unknown"), F.lit("200")),
    )
    accounts = table(spark, sf_dir, "customer").select(
        _shop_url("customer", F.col("c_custkey")).alias("url"),
        F.lit("db_unfetched").alias("status"),
        (F.lit(START * 1000) + F.col("c_custkey") * 2000).alias("fetch_time"),
        F.lit(0.0).alias("score"),
        (F.col("c_nationkey") * 86_400 + 3600).cast("int").alias("fetch_interval"),
        F.lit(1).alias("retries"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )
    return union_all([web, images, accounts])


def knowledge_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kb_url, kb_text."""
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("kb:"), F.col("item_id").cast("string")).alias("kb_url"), F.col("text").alias("kb_text"))


def knowledge_base_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knowledge-base lines in `value`: of one field (nations), two (suppliers) and three (customers)."""
    part = lambda name, *columns: table(spark, sf_dir, name).select(
        F.concat_ws(KB_DELIMITER, *columns).alias("value"))
    return (part("nation", "n_name").union(part("supplier", "s_name", "s_name"))
            .union(part("customer", "c_name", "c_mktsegment", "c_name")))


DUMP_PARTS = {
    "web": "file:///dump/part-00000",
    "files": "file:///dump/part-00001",
    "shop": "file:///dump/part-00002",
    "web2": "file:///dump/part-00003",
}


def dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumped documents of both crawls with the `path` of their file, one file per segment."""
    path_of = F.create_map(*[F.lit(part) for pair in DUMP_PARTS.items() for part in pair])
    pages = recrawled_content(spark, sf_dir).withColumn("path", F.try_element_at(path_of, F.col("segment")))
    return dump_records(pages, LABELS, carry=["path"])


def open_lines(dump: DataFrame) -> DataFrame:
    """Dumped documents as JSON lines with `path`, carrying nested fields that no schema of the library knows."""
    extra = F.struct(F.struct(F.col("url").alias("address of page")).alias("seen"),
                     F.array(F.length("url"), F.length("raw_content")).alias("sizes"))
    fields = [name for name in dump.columns if name != "path"]
    return dump.select("path", F.to_json(F.struct(*fields, extra.alias("extra"))).alias("value"))


def dump_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dump, and documents without body or URL, each line twice."""
    nations = table(spark, sf_dir, "nation")
    bare = nations.select(
        F.lit("file:///dump/part-00004").alias("path"), F.col("n_name").alias("_id"),
        F.when(F.col("n_regionkey") > 0, _shop_url("nation", F.col("n_nationkey"))).alias("url"),
        F.when(F.col("n_regionkey") == 1, F.col("n_name")).alias("raw_content"))
    lines = dump(spark, sf_dir).select("path", "_id", "url", "raw_content").union(bare)
    return lines.union(lines)
