"""Documents and their chunks as tables that are replaced document by document (W9, W10), the run that fetches them (S9, T2),
and small lists (S10, S11, W15)."""

from __future__ import annotations

import datetime
import json
import os
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chronofact.functions import scalar
from chronofact.operators.text import changed_documents, chunk_documents, page_text
from chronofact.session import cut
from chronofact.sources.store import ObjectStore, SwapTable, file_sha256


def replace_documents(current: DataFrame, new: DataFrame, key: str = "adsh") -> DataFrame:
    """The table with the documents of `new` replaced; others stay. Rows without a key in `new` are left out, as they
    replace nothing. Extra columns of either side must be the same."""
    fresh = new.where(F.col(key).isNotNull())
    kept = current.join(fresh.select(key).distinct(), key, "left_anti").select(*current.columns)
    return kept.unionByName(fresh.select(*current.columns))


def rechunk(current: DataFrame, cut_anew: DataFrame, key: str = "adsh") -> tuple[DataFrame, DataFrame]:
    """(the chunks after re-cutting, the documents that changed). Documents whose set of chunk ids is the same keep
    their rows as they are; documents that have no chunks any more lose theirs."""
    changed = cut(changed_documents(current, cut_anew, key), "changed")
    columns = current.columns
    kept = current.join(changed, key, "left_anti").select(*columns)
    return kept.unionByName(cut_anew.join(changed, key, "left_semi").select(*columns)), changed


def filings_to_fetch(submissions: DataFrame, companies: DataFrame, forms: list[str], limit: int | None = None) -> DataFrame:
    """Filings of the tracked companies with a document, in order of form and day, at most `limit` a company.

    companies: cik. A filing listed twice counts once.
    """
    s = submissions.where(F.col("form").isin(forms) & F.col("instance").isNotNull() & (F.col("instance") != "")).select("adsh", "cik", "form", "filed", "instance").distinct()
    s = s.join(companies.select("cik").distinct(), "cik", "left_semi")
    w = Window.partitionBy("cik").orderBy(F.array_position(F.array(*map(F.lit, forms)), F.col("form")), F.col("filed").asc_nulls_last(), "adsh")
    placed = s.withColumn("place", F.row_number().over(w))
    return placed.where(F.col("place") <= limit) if limit else placed


def read_companies(path: str) -> tuple[list[dict], list[str]]:
    """(tracked companies, forms in order of preference) of a JSON file, or a YAML file where a parser is installed.
    Every company needs a cik."""
    with open(path) as f:
        text = f.read()
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs a parser; use JSON") from e
        found = yaml.safe_load(text)
    else:
        found = json.loads(text)
    companies = found.get("companies") or []
    if bad := [c for c in companies if not isinstance(c, dict) or not isinstance(c.get("cik"), int)]:
        raise ValueError(f"companies without a cik: {bad[:3]}")
    return companies, list(found.get("forms") or [])


DOCUMENTS = "adsh string, cik int, company string, form string, filed date, source_url string, object_key string, raw_sha256 string, n_chars int, n_chunks int"
CHUNKS = "chunk_id string, adsh string, cik int, section string, chunk_index int, text string, n_chars int"


@dataclass
class DocumentRun:
    """The document step: fetch the wanted filings' documents, keep what is new, cut it, and account for it.

    fetch(url, path) writes a file (see ingest.download) to the landing folder, where the driver keeps it until it is stored;
    between requests `pause` seconds pass. Fetching is the driver's work, in batches of `batch` files; cutting is Spark's,
    from the stored objects of a batch.
    """

    spark: SparkSession
    root: str
    store: ObjectStore
    fetch: Callable[[str, str], object]
    landing: str
    base_url: str
    ledger: SwapTable | None = None
    pause: float = 0.15
    sleep: Callable[[float], None] = time.sleep
    batch: int = 64

    def __post_init__(self):
        self.documents = SwapTable(self.spark, f"{self.root}/documents", DOCUMENTS)
        self.chunks = SwapTable(self.spark, f"{self.root}/chunks", CHUNKS)

    def run(self, submissions: DataFrame, companies: list[dict], forms: list[str], limit: int) -> dict:
        """Figures of the run. A document whose content is known is skipped; a changed one replaces its rows and
        chunks. At most `limit` filings are asked for in all."""
        tracked = self.spark.createDataFrame([(int(c["cik"]),) for c in companies], "cik int")
        names = submissions.where("adsh is not null").groupBy("adsh").agg(F.max("name").alias("company"))
        wanted = filings_to_fetch(submissions, tracked, forms).join(names, "adsh", "left").withColumn("url", scalar.document_url(self.base_url, F.col("cik"), F.col("adsh"), F.col("instance"))).orderBy("cik", "place").limit(limit).collect()  # `limit` rows
        known = {r["adsh"]: r["raw_sha256"] for r in self.documents.read().where(F.col("adsh").isin([r["adsh"] for r in wanted])).select("adsh", "raw_sha256").collect()}
        stats = {"seen": 0, "fetched": 0, "skipped": 0, "chunks": 0, "bytes": 0}
        os.makedirs(self.landing, exist_ok=True)
        for at in range(0, len(wanted), self.batch):
            new = []
            for r in wanted[at : at + self.batch]:
                local = os.path.join(self.landing, r["adsh"] + ".htm")
                self.fetch(r["url"], local)
                self.sleep(self.pause)
                stats["seen"] += 1
                sha = file_sha256(local)
                if known.get(r["adsh"]) == sha:
                    stats["skipped"] += 1
                else:
                    key = f"documents/{r['cik']}/{r['adsh']}/primary.htm"
                    self.store.put_file(local, key, r["url"], adsh=r["adsh"], cik=r["cik"], form=r["form"])
                    stats["bytes"] += os.path.getsize(local)
                    new.append((r["adsh"], r["cik"], r["company"], r["form"], r["filed"], r["url"], key, sha))
                os.remove(local)
            if new:
                stats["fetched"] += len(new)
                stats["chunks"] += self._replace(new)
        if self.ledger is not None:
            now = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
            self.ledger.append([(now, "documents.fetch", "requests", float(stats["seen"]), 0.0, json.dumps(stats))])
        return stats

    def _replace(self, new: list[tuple]) -> int:
        """Cut the stored documents of a batch and put them in place of what the tables had of them; number of chunks."""
        meta = self.spark.createDataFrame(new, "adsh string, cik int, company string, form string, filed date, source_url string, object_key string, raw_sha256 string")
        pages = self.spark.read.format("binaryFile").load([self.store.path(r[6]) for r in new])
        key = F.regexp_extract("path", r"([^/]+)/primary\.htm$", 1)
        texts = cut(page_text(pages.select(key.alias("adsh"), F.col("content").cast("string").alias("html")), "adsh", "html"), "texts")
        chunks = cut(chunk_documents(texts).join(meta.select("adsh", "cik"), "adsh").select(*(c.split()[0] for c in CHUNKS.split(", "))), "chunks")
        per = chunks.groupBy("adsh").agg(F.count(F.lit(1)).cast("int").alias("n_chunks"))
        rows = meta.join(texts.select("adsh", F.length("text").alias("n_chars")), "adsh").join(per, "adsh", "left").withColumn("n_chunks", F.coalesce("n_chunks", F.lit(0)))
        fresh = cut(rows.select(*(c.split()[0] for c in DOCUMENTS.split(", "))), "documents")
        self.documents.rewrite(lambda t: replace_documents(t, fresh))
        # chunks of a document that is replaced go, whether it has new ones or not
        self.chunks.rewrite(lambda t: t.join(fresh.select("adsh"), "adsh", "left_anti").select(*t.columns).unionByName(chunks))
        return chunks.count()


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped, a broken line raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


@dataclass
class Reports:
    """One small JSON file per evaluated index version."""

    folder: str

    def write(self, result: dict) -> str:
        os.makedirs(self.folder, exist_ok=True)
        path = os.path.join(self.folder, f"{result['index_version']}.json")
        with open(path + ".part", "w") as f:
            json.dump(result, f, indent=2, default=str)
        os.replace(path + ".part", path)
        return path

    def read(self, version: str) -> dict:
        with open(os.path.join(self.folder, f"{version}.json")) as f:
            return json.load(f)
