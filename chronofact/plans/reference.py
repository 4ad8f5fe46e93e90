"""Queries over the versioned facts, marts, checks, documents and retrieval, with the SQL that checks them."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofact import schema
from chronofact.functions import scalar
from chronofact.operators import checks, index, lexical, marts, pit, retrieval, text, versions
from chronofact.sources import documents
from chronofact.sources.tables import table

KNOWN_ON = datetime.date(2022, 6, 30)
DIMS = 64
#: Forms in order of preference, as a fetch list would have them.
FORMS = ["10-K", "10-Q", "8-K"]


def fact_versions(spark: SparkSession, d: str) -> DataFrame:
    """K1: all versions with their windows."""
    return versions.fact_versions(table(spark, d, "facts"), table(spark, d, "submissions"))


def facts_as_of(spark: SparkSession, d: str) -> DataFrame:
    """What was known on a day."""
    return pit.as_of(fact_versions(spark, d), KNOWN_ON).select("fact_key", "value", "adsh", "valid_from", "version_no")


def fact_history(spark: SparkSession, d: str) -> DataFrame:
    """L2: all versions of one company's concept."""
    return fact_versions(spark, d).where("tag = 'Revenues' and coreg is null").select("fact_key", "cik", "ddate", "qtrs", "version_no", "n_versions", "value", "valid_from", "valid_to", "is_latest")


def history_read(spark: SparkSession, d: str) -> DataFrame:
    """/facts/history (E5): the versions of the first company's newest annual net income that was reported twice or more."""
    v = fact_versions(spark, d)
    some = v.where("tag = 'NetIncomeLoss' and coreg is null and not is_dimensional and qtrs = 4 and n_versions > 1").agg(F.min(F.struct("cik", F.datediff(F.lit("9999-12-31"), "ddate").alias("age"), "ddate")).alias("x")).select("x.*").first()
    return pit.history(v, some["cik"] if some["cik"] is not None else -1, "NetIncomeLoss", some["ddate"] or KNOWN_ON, 4)


def company_read(spark: SparkSession, d: str) -> DataFrame:
    """/companies (L3, E6): a company's periods, newest first."""
    return pit.company(company_quarter(spark, d), 884411).unionByName(pit.company(company_quarter(spark, d), 1000020)).select("cik", "fy", "fp", "period_end", "revenue", "net_income", "total_assets", "leverage_ratio")


def index_history(spark: SparkSession, d: str) -> DataFrame:
    """/index (L10, E2): the newest index versions, ties by name."""
    return table(spark, d, "index_versions").orderBy(F.desc("created_at"), "index_version").limit(20).select("index_version", "model", "dims", "n_chunks", "status")


def typed_text(spark: SparkSession, d: str) -> DataFrame:
    """Columns of submissions written as the archives write them, and read back."""
    s = table(spark, d, "submissions")
    text = s.select("adsh", F.format_string("%d", "cik").alias("cik"), F.date_format("filed", "yyyyMMdd").alias("filed"), F.concat(F.date_format("accepted", "yyyy-MM-dd HH:mm:ss"), F.lit(".0")).alias("accepted"), F.when(F.col("prevrpt"), "1").otherwise("0").alias("prevrpt"), F.coalesce("stprba", F.lit("NULL")).alias("stprba"))
    return text.select("adsh", scalar.to_int(F.col("cik")).alias("cik"), scalar.to_day(F.col("filed")).alias("filed"), scalar.to_moment(F.col("accepted")).alias("accepted"), scalar.flag(F.col("prevrpt")).alias("prevrpt"), scalar.null_tokens(F.col("stprba")).alias("stprba")).distinct()


def required_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Q8, Q9: columns of the loaded tables that must be filled, and how many rows lack them."""
    out = None
    for name, declared in (("facts", schema.FACTS), ("submissions", schema.SUBMISSIONS)):
        t = schema.conform(table(spark, d, name), declared, check=False)
        required = [f.name for f in declared if not f.nullable]
        counts = t.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required)).unpivot([], required, "column_name", "n_null").select(F.lit(name).alias("table_name"), "column_name", "n_null")
        out = counts if out is None else out.unionByName(counts)
    return out


def vector_filter(spark: SparkSession, d: str) -> DataFrame:
    """Embedded chunks with their documents' form, for some companies and forms."""
    e = table(spark, d, "chunk_embeddings").where("embedding is not null").select("index_version", "chunk_id").distinct()
    c = table(spark, d, "chunks").where("chunk_id is not null").groupBy("chunk_id").agg(F.min("adsh").alias("adsh"), F.min("cik").alias("cik"))
    docs = table(spark, d, "documents").where("adsh is not null").select("adsh", "form").distinct()
    found = e.join(c, "chunk_id").join(docs, "adsh").where(F.array_contains(F.array(F.lit("10-K"), F.lit("10-Q")), F.col("form")))
    return found.groupBy("index_version", "cik", "form").agg(F.count(F.lit(1)).alias("n_vectors"))


def facts_read(spark: SparkSession, d: str) -> DataFrame:
    """/facts: consolidated facts of a company as known on a day, newest period first; the company is the first that had
    reported the concept by then."""
    reported = table(spark, d, "facts").where((F.col("tag") == "Assets") & F.col("coreg").isNull() & (F.col("knowledge_date") <= F.lit(KNOWN_ON)))
    return pit.facts(fact_versions(spark, d), reported.agg(F.min("cik")).first()[0], "Assets", KNOWN_ON, limit=50)


def restatements(spark: SparkSession, d: str) -> DataFrame:
    return marts.restatements(fact_versions(spark, d))


def restatements_top(spark: SparkSession, d: str) -> DataFrame:
    """L4, P11."""
    return pit.top_restatements(restatements(spark, d), least_change=0.01, limit=100).select("fact_key", "original_value", "latest_value", "rel_change")


def days_between(spark: SparkSession, d: str) -> DataFrame:
    """facts restated by the days it took."""
    return restatements(spark, d).groupBy("days_between").agg(F.count(F.lit(1)).alias("n_facts"))


def company_quarter(spark: SparkSession, d: str) -> DataFrame:
    """A5: the period pivot."""
    return marts.company_quarter(fact_versions(spark, d), table(spark, d, "submissions"))


def company_latest(spark: SparkSession, d: str) -> DataFrame:
    return marts.company_latest(company_quarter(spark, d)).select("cik", "company_name", "fy", "fp", "period_end", "revenue", "net_income", "total_assets")


def first_reported(spark: SparkSession, d: str) -> DataFrame:
    """The day each headline fact was first reported."""
    return marts.headline_versions(fact_versions(spark, d)).select("fact_key", "first_reported", "value")


def period_labels(spark: SparkSession, d: str) -> DataFrame:
    return marts.period_labels(table(spark, d, "submissions"))


def data_quality(spark: SparkSession, d: str) -> DataFrame:
    """A2, A6, J7-J9."""
    n = restatements(spark, d).agg(F.count(F.lit(1)).alias("n_restated_facts"))
    return marts.data_quality(table(spark, d, "facts"), table(spark, d, "submissions"), n)


def ambiguous_facts(spark: SparkSession, d: str) -> DataFrame:
    """A1."""
    return versions.ambiguous_pairs(table(spark, d, "facts"))


def null_rate(spark: SparkSession, d: str) -> DataFrame:
    """Null values by quarter."""
    n = table(spark, d, "facts").groupBy("quarter").agg(F.count(F.lit(1)).alias("n_facts"), F.count_if(F.col("value").isNull()).alias("n_null_values"))
    return n.withColumn("pct_null_values", scalar.percent(F.col("n_null_values"), F.col("n_facts"), 3))


def check_not_null(spark: SparkSession, d: str) -> DataFrame:
    """Q1 on facts.value."""
    return checks.not_null(table(spark, d, "facts"), "value").groupBy("tag").agg(F.count(F.lit(1)).alias("n_rows"))


def check_unique(spark: SparkSession, d: str) -> DataFrame:
    """Q2: submissions listed more than once."""
    return checks.duplicates(table(spark, d, "submissions"), "adsh")


def check_unique_combo(spark: SparkSession, d: str) -> DataFrame:
    """Q5 on a published build of versions."""
    return checks.duplicates(table(spark, d, "fact_versions"), "fact_key", "version_no")


def check_accepted(spark: SparkSession, d: str) -> DataFrame:
    """Q3 on submissions.fp."""
    return checks.not_accepted(table(spark, d, "submissions"), "fp", ["FY", "Q1", "Q2", "Q3"]).groupBy("fp").agg(F.count(F.lit(1)).alias("n_rows"))


def check_range(spark: SparkSession, d: str) -> DataFrame:
    """Q4 on data_quality."""
    return checks.out_of_range(table(spark, d, "data_quality"), "pct_filings_with_facts", 50, 100).select("build_id", "pct_filings_with_facts")


def check_single_latest(spark: SparkSession, d: str) -> DataFrame:
    """Q6 on a published build."""
    return checks.not_single_latest(table(spark, d, "fact_versions"))


def check_windows_tile(spark: SparkSession, d: str) -> DataFrame:
    """Q7 on a published build, each version as first closed."""
    v = table(spark, d, "fact_versions").groupBy("fact_key", "version_no").agg(F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
    return checks.gaps_in_windows(v)


def orphan_facts(spark: SparkSession, d: str) -> DataFrame:
    """J2 as a check: facts that the earlier published build of versions lacks."""
    return checks.orphans(table(spark, d, "facts").select("fact_key").distinct(), table(spark, d, "fact_versions"), "fact_key")


def optional_filter(spark: SparkSession, d: str) -> DataFrame:
    """P5, P6."""
    f = pit.optional(table(spark, d, "facts"), cik=None, tag="Assets", fp="FY").where(F.col("uom").isin("USD", "USD/shares"))
    return f.groupBy("cik").agg(F.count(F.lit(1)).alias("n_facts"), F.min("knowledge_date").alias("first_day"), F.max("knowledge_date").alias("last_day"))


def top_filings(spark: SparkSession, d: str) -> DataFrame:
    """The first filings of each company in order of form and day."""
    subs = table(spark, d, "submissions")
    found = documents.filings_to_fetch(subs, subs.select("cik"), FORMS, 3)
    return found.withColumn("place", F.col("place").cast("bigint")).withColumn("url", scalar.document_url("https://filings.example/data", F.col("cik"), F.col("adsh"), F.col("instance")))


def quarter_calendar(spark: SparkSession, d: str) -> DataFrame:
    """filings by the quarter of their day, beside the quarter they were loaded with."""
    return table(spark, d, "submissions").where("filed is not null").groupBy("quarter", scalar.quarter_of(F.col("filed")).alias("filed_quarter")).agg(F.count(F.lit(1)).alias("n_filings"))


def fact_key(spark: SparkSession, d: str) -> DataFrame:
    """keys rebuilt from their parts."""
    f = table(spark, d, "facts")
    key = scalar.fact_key(F.col("cik"), F.col("tag"), F.date_format("ddate", "yyyyMMdd"), F.col("qtrs"), F.col("uom"), F.col("coreg"), F.col("segments"))
    return f.select(key.alias("rebuilt"), "fact_key").groupBy((F.col("rebuilt") == F.col("fact_key")).alias("agrees")).agg(F.count(F.lit(1)).alias("n_facts"))


def cost_by_stage(spark: SparkSession, d: str) -> DataFrame:
    """A10: what embedding the chunks of each index version anew would cost, by model and in all."""
    v = table(spark, d, "index_versions").groupBy("index_version").agg(F.max("model").alias("model"), F.max("created_at").alias("created_at"))
    held = table(spark, d, "chunk_embeddings").select("index_version", "chunk_id").distinct().join(_chunks(spark, d).select("chunk_id", F.length("text").alias("chars")), "chunk_id")
    per = held.groupBy("index_version").agg(F.count(F.lit(1)).cast("double").alias("quantity"), F.sum("chars").alias("chars")).join(v, "index_version")
    ledger = per.select(F.col("created_at").alias("run_at"), F.col("model").alias("stage"), "quantity", scalar.hosted_cost(F.col("chars")).alias("usd"))
    return pit.cost_by_stage(ledger).drop("last_run")


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def _dense(v: DataFrame, k: int = 5) -> DataFrame:
    """The stated query set: every id divisible by 100, against all rows."""
    q = v.where("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding")
    return retrieval.dense_topk(v, q, k, DIMS)


def dense_topk(spark: SparkSession, d: str) -> DataFrame:
    """R1, L5."""
    return _dense(_vectors(spark, d)).select("query_id", "id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


def dense_topk_filtered(spark: SparkSession, d: str) -> DataFrame:
    """The filter before the search."""
    v = _vectors(spark, d)
    q = v.where("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding")
    return retrieval.dense_topk(v.where("label in (1, 2, 3)"), q, 5, DIMS).select("query_id", "id", F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


def _by_label(v: DataFrame) -> DataFrame:
    """A second ranked list: vectors of the query's label in order of id."""
    q = v.where("id % 100 = 0").select(F.col("id").alias("query_id"), "label")
    w = Window.partitionBy("label").orderBy("id")
    first = v.select("id", "label", F.row_number().over(w).alias("rank")).where("rank <= 30")
    return q.join(first, "label").select("query_id", "id", "rank")


def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    """R3, J13."""
    v = _vectors(spark, d)
    f = retrieval.rrf([_dense(v, 30), _by_label(v)], 10)
    return f.select("query_id", "id", F.round("score", 9).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def known_item_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The expected item of a query is the vector after it."""
    v = _vectors(spark, d)
    expected = v.where("id % 100 = 0").select(F.col("id").alias("query_id"), (F.col("id") + 1).alias("id"))
    return retrieval.known_item_metrics(_dense(v), expected)


def index_percentile(spark: SparkSession, d: str) -> DataFrame:
    """A13 on the values of events."""
    return retrieval.index_percentiles(table(spark, d, "events"), "value", {"p50": 0.5, "p95": 0.95})


def promotion_gate(spark: SparkSession, d: str) -> DataFrame:
    """R10 as columns: each version's recorded metrics against the floor and the version promoted."""
    v = table(spark, d, "index_versions").select("index_version", "status", F.get_json_object("eval", "$.recall_at_5").cast("double").alias("r5"))
    best = v.where("status = 'promoted'").agg(F.max("r5").alias("promoted_r5"))
    low = F.col("r5") < index.FLOORS["known_item_recall_at_5"]
    fell = F.col("r5") < F.col("promoted_r5") - index.MOST_REGRESSION
    return v.crossJoin(F.broadcast(best)).select("index_version", F.coalesce(low, F.lit(False)).alias("below_floor"), F.coalesce(fell, F.lit(False)).alias("regressed"), (~F.coalesce(low | fell, F.lit(False))).alias("passes"))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunks").where("chunk_id is not null").dropDuplicates(["chunk_id"])


#: The stated query set: the first 15 hex digits of the id, as a number, are divisible by 100 (the ids are hashes).
ASKS = "cast(conv(substr(chunk_id, 1, 15), 16, 10) as bigint) % 100 = 0"


def _questions(c: DataFrame, words: int) -> DataFrame:
    """Questions of a few words from every chunk that asks."""
    w = F.filter(F.split(F.lower("text"), r"[^a-z]+"), lambda x: F.length(x) > 5)
    return c.where(ASKS).select(F.col("chunk_id").alias("query_id"), F.array_join(F.slice(F.array_distinct(w), 1, words), " ").alias("query"))


def lexical_and_match(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that hold all words of a question (no stemming, so that SQL can check it)."""
    c = _chunks(spark, d)
    return lexical.lexical_matches(lexical.index_terms(c, english=False), _questions(c, 3), english=False).select("query_id", "chunk_id")


def lexical_topk(spark: SparkSession, d: str) -> DataFrame:
    """With stems, ranked by cover density."""
    c = _chunks(spark, d)
    return retrieval.ranked(lexical.lexical_matches(lexical.index_terms(c), _questions(c, 4)).withColumnRenamed("chunk_id", "id"), 30)


def hybrid_topk(spark: SparkSession, d: str) -> DataFrame:
    """Fused dense and lexical candidates (hashed embeddings)."""
    c = _chunks(spark, d)
    q = _questions(c, 4)
    e = index.HashingEmbedder()
    v = index.embed(c, e).withColumnRenamed("chunk_id", "id")
    asked = index.embed(q.select(F.col("query_id").alias("chunk_id"), F.col("query").alias("text")), e).withColumnRenamed("chunk_id", "query_id")
    words = retrieval.ranked(lexical.lexical_matches(lexical.index_terms(c), q).withColumnRenamed("chunk_id", "id"), retrieval.CANDIDATES)
    return retrieval.rrf([retrieval.dense_topk(v, asked, retrieval.CANDIDATES, e.dims), words], 5)


def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    """D1."""
    return text.page_text(table(spark, d, "documents"), "doc_id", "text").select("doc_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("sha256"))


def split_sections(spark: SparkSession, d: str) -> DataFrame:
    """D2, D3."""
    return text.sections(table(spark, d, "documents"), "doc_id", "text").select("doc_id", "place", "item", "title", F.length("text").alias("n_chars"))


def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    """D3-D5."""
    return text.chunk_documents(table(spark, d, "documents"), "doc_id")


def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    """F16: content addresses of the chunks as they are."""
    return _chunks(spark, d).select("chunk_id", scalar.chunk_id(F.col("adsh"), F.col("section"), F.col("chunk_index"), F.col("text")).alias("address"))


def word_window(spark: SparkSession, d: str) -> DataFrame:
    """F21."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", scalar.word_window(F.col("text")).alias("query"))


def incremental_reuse(spark: SparkSession, d: str) -> DataFrame:
    """Per model and pair of versions, the chunks with a vector to take over and those to embed."""
    e = table(spark, d, "chunk_embeddings").select("index_version", "chunk_id").distinct()
    v = table(spark, d, "index_versions").select("index_version", "model", "created_at").distinct()
    w = Window.partitionBy("model").orderBy("created_at", "index_version")
    pairs = v.withColumn("source", F.lag("index_version").over(w)).where("source is not null").select("index_version", "source")
    now = e.join(F.broadcast(pairs), "index_version") if v.count() <= 100_000 else e.join(pairs, "index_version")
    old = e.select(F.col("index_version").alias("source"), "chunk_id", F.lit(1).alias("old"))
    return now.join(old, ["source", "chunk_id"], "left").groupBy("index_version", "source").agg(F.count("old").alias("n_reused"), F.count_if(F.col("old").isNull()).alias("n_new"))


def rechunk_diff(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose chunks differ if they are cut anew with a smaller limit."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("adsh"), "text")
    return text.changed_documents(text.chunk_documents(docs), text.chunk_documents(docs, limit=1000)).withColumnRenamed("adsh", "doc_id")


def stale_eval_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of each index version that a build without the reports' risk sections would leave stale."""
    items = table(spark, d, "chunk_embeddings").select(F.col("chunk_id").alias("id"), "index_version").distinct()
    build = table(spark, d, "chunks").where("section is null or lower(section) not like '%1a%'")
    return index.stale_items(items, build).groupBy("index_version").agg(F.count(F.lit(1)).alias("n_stale"))


_Q = (fact_versions, facts_as_of, fact_history, history_read, company_read, index_history, typed_text, required_nulls, vector_filter, facts_read, restatements, restatements_top, days_between, company_quarter, company_latest, first_reported, period_labels, data_quality, ambiguous_facts, null_rate, check_not_null, check_unique, check_unique_combo, check_accepted, check_range, check_single_latest, check_windows_tile, orphan_facts, optional_filter, top_filings, quarter_calendar, fact_key, cost_by_stage, dense_topk, dense_topk_filtered, rrf_fusion, known_item_metrics, index_percentile, promotion_gate, lexical_and_match, lexical_topk, hybrid_topk, html_to_text, split_sections, chunk_documents, chunk_ids, word_window, incremental_reuse, rechunk_diff, stale_eval_items)
QUERIES = {f.__name__: f for f in _Q}
