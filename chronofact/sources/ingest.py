"""Idempotent ingest (K3): the same archive is loaded once, a changed one replaces exactly its quarter."""

from __future__ import annotations

import datetime
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofact import schema
from chronofact.operators import marts, versions
from chronofact.session import cut
from chronofact.sources.archive import malformed_lines, read_archive, typed_rows
from chronofact.sources.store import ObjectStore, PartitionedTable, SwapTable


class NotPublished(LookupError):
    """The source has no archive for the quarter (yet)."""


def download(url: str, path: str, tries: int = 3, open_url: Callable = urllib.request.urlopen, sleep: Callable[[float], None] = time.sleep) -> str:
    """Fetch a file with doubling pauses; 404 means not published. Other codes than 403, 429, 503 aren't retried."""
    for attempt in range(tries):
        try:
            with open_url(url) as src, open(path + ".part", "wb") as dst:
                while block := src.read(1 << 20):
                    dst.write(block)
            import os

            os.replace(path + ".part", path)
            return path
        except urllib.error.HTTPError as e:
            if e.code == 404:
                raise NotPublished(url) from e
            if e.code not in (403, 429, 503) or attempt == tries - 1:
                raise
        except (TimeoutError, ConnectionError, urllib.error.URLError):
            if attempt == tries - 1:
                raise
        sleep(2**attempt)
    raise AssertionError


#: Published tables, in the order in which they are built.
GOLD = ("fact_versions", "restatements", "company_quarter", "data_quality")


@dataclass
class Lakehouse:
    """Silver and gold tables under one folder, fed from an object store of archives."""

    spark: SparkSession
    root: str
    bronze: ObjectStore

    def __post_init__(self):
        self.submissions = PartitionedTable(self.spark, f"{self.root}/silver/submissions", schema.SUBMISSIONS)
        self.facts = PartitionedTable(self.spark, f"{self.root}/silver/facts", schema.FACTS)
        self.processed = SwapTable(self.spark, f"{self.root}/silver/processed_manifest", "dataset string, quarter string, source_sha256 string, n_submissions int, n_facts int, processed_at timestamp_ntz")

    def already_processed(self, quarter: str, sha256: str) -> bool:
        """W4."""
        return not self.processed.read().where((F.col("quarter") == quarter) & (F.col("source_sha256") == sha256)).isEmpty()

    def load_quarter(self, quarter: str, force: bool = False) -> dict:
        """Replace the quarter unless this archive was loaded before. The manifest row is written last, so a load
        that broke off is done again."""
        manifest = self.bronze.manifest(f"{quarter}.zip")
        if manifest is None:
            raise FileNotFoundError(f"no archive of {quarter} has landed")
        sha = manifest["sha256"]
        if not force and self.already_processed(quarter, sha):
            return {"quarter": quarter, "skipped": True}
        now = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
        sub, num, bad = read_archive(self.spark, self.bronze.path(f"{quarter}.zip"))
        # parsed once, to a staging table; checks, counts and the replacement read that
        staged = [cut(df, "staged") for df in typed_rows(sub, num, quarter, sha, now, check=False)]
        counts = [schema.require_filled(df, declared) for df, declared in zip(staged, (schema.SUBMISSIONS, schema.FACTS), strict=True)]
        for table, df, n in zip((self.submissions, self.facts), staged, counts, strict=True):
            table.replace(df, quarter, n)
        malformed = malformed_lines(bad)
        self.processed.append([("fsds", quarter, sha, *counts, now)])
        return {"quarter": quarter, "skipped": False, "n_submissions": counts[0], "n_facts": counts[1], "n_malformed": sum(malformed.values()), "malformed": malformed}

    def publish(self, name: str, df: DataFrame) -> DataFrame:
        """Write a gold table anew, beside the old one, then drop that."""
        t = SwapTable(self.spark, f"{self.root}/gold/{name}", "")
        old = t._current()
        number = int(old.rsplit("v", 1)[1]) + 1 if old else 0
        schema.normalize_for_publish(df).write.parquet(f"{t.path}/v{number:012d}")
        return self.gold(name)

    def gold(self, name: str) -> DataFrame:
        at = SwapTable(self.spark, f"{self.root}/gold/{name}", "")._current()
        if at is None:
            raise LookupError(f"gold table {name} was never published")
        return self.spark.read.parquet(at)

    def serve(self, database: str = "gold") -> list[str]:
        """Read-only views of the published tables under a name of the catalog; published anew, views move on."""
        self.spark.sql(f"create database if not exists {database}")
        for name in GOLD:
            at = SwapTable(self.spark, f"{self.root}/gold/{name}", "")._current()
            if at is None:
                raise LookupError(f"gold table {name} was never published")
            self.spark.sql(f"create or replace view {database}.{name} as select * from parquet.`{at}`")
        return [f"{database}.{name}" for name in GOLD]

    def build_gold(self) -> dict[str, DataFrame]:
        """fact_versions, then what depends on it; each is written once and read by the next."""
        subs, facts = self.submissions.read(), self.facts.read()
        v = self.publish("fact_versions", versions.fact_versions(facts, subs))
        r = self.publish("restatements", marts.restatements(v))
        c = self.publish("company_quarter", marts.company_quarter(v, subs).withColumn("built_at", F.current_timestamp()))
        q = self.publish("data_quality", marts.data_quality(facts, subs, r.agg(F.count(F.lit(1)).alias("n_restated_facts"))).withColumn("built_at", F.current_timestamp()))
        return {"fact_versions": v, "restatements": r, "company_quarter": c, "data_quality": q}


@dataclass
class Pipeline:
    """Steps in order: land, load, build, check; then, if they are given, documents, embedding and its evaluation. Quarters
    are loaded oldest first; running it again is harmless.

    documents: called without arguments, fetches and cuts documents (DocumentRun.run). index: an Index over their chunks.
    """

    lakehouse: Lakehouse
    fetch: Callable[[str], str] | None = None
    documents: Callable[[], dict] | None = None
    index: object | None = None
    intents: DataFrame | None = None

    def run(self, quarters: list[str], force: bool = False) -> dict:
        from chronofact.operators import checks

        loaded = []
        for q in sorted(quarters):
            if self.fetch:
                try:
                    self.lakehouse.bronze.put_file(self.fetch(q), f"{q}.zip")
                except NotPublished:
                    continue
            loaded.append(self.lakehouse.load_quarter(q, force))
        gold = self.lakehouse.build_gold()
        v = gold["fact_versions"]
        checks.require_none("one latest version per fact", checks.not_single_latest(v))
        checks.require_none("windows tile", checks.gaps_in_windows(v))
        out = {"loaded": loaded, "gold": gold}
        if self.documents:
            out["documents"] = self.documents()
        if self.index is not None:
            version = self.index.build()
            metrics = self.index.evaluate(version, self.index.known_item_set(), self.intents)
            out["evaluation"] = self.index.decide(version, metrics)
            checks.require_promoted(self.index.promoted())
        return out
