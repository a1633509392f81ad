"""State tables as Parquet: extractions, courses, runs, results, findings, metrics; run states and resume.

Spark has no transaction over several tables.  A batch of audits is written below a staging folder and a commit marker
is added last; readers take only batches with a marker, so what a lost driver left behind is never seen.  A table that
is replaced gets a new version beside the old one, and a pointer that is renamed into place last: a driver lost at any
point leaves a whole table.
"""

from __future__ import annotations

import json
import logging
import uuid
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, schemas
from ..functions import columns as C
from ..operators import relational as R

#: Run states that can be resumed.
RESUMABLE = ("failed", "running", "created")
AUDIT_TABLES = ("results", "findings", "field_findings")
#: Tables that grow by batches, which their marks make visible.
BATCHED = (*AUDIT_TABLES, "extractions")


class Store:
    """Tables below one folder; any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _list(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def init(self) -> list[str]:
        """Create what is missing; the names of all tables."""
        for name, ddl in schemas.TABLES.items():
            if not self._exists(f"{self.root}/{name}"):
                self.spark.createDataFrame([], schemas.struct(ddl)).write.parquet(f"{self.root}/{name}/0")
        return sorted(schemas.TABLES)

    def clear(self, *names: str) -> None:
        """Empty tables; the numbers of their rows begin anew."""
        for name in names or schemas.TABLES:
            self._replace(name, self.spark.createDataFrame([], schemas.struct(schemas.TABLES[name])))
        for folder in {self._marks(n) for n in names or BATCHED if n in BATCHED}:
            fs, p = self._fs(folder)
            fs.delete(p, True)

    def _version(self, name: str) -> str:
        """The folder of the table's current version: the highest number whose pointer stands."""
        done = [int(x[:-5]) for x in self._list(f"{self.root}/{name}") if x.endswith(".done")]
        return f"{self.root}/{name}/{max(done, default=0)}"

    def _marks(self, name: str) -> str:
        """The folder of the marks that make a table's batches visible; the tables of an audit share theirs."""
        return f"{self.root}/_marks" + ("" if name in AUDIT_TABLES else f"_{name}")

    def read(self, name: str) -> DataFrame:
        schema = schemas.struct(schemas.TABLES[name])
        df = self.spark.read.schema(schema).parquet(self._version(name))
        marks = self._list(self._marks(name)) if name in BATCHED else []
        if marks:  # one scan of all marked batches
            df = df.unionByName(self.spark.read.schema(schema).parquet(*[f"{self.root}/batches/{m}/{name}" for m in marks]))
        return df

    def _replace(self, name: str, df: DataFrame) -> None:
        """Write the table's next version, which may be made of the current one, then point to it; older ones go."""
        current = self._version(name)
        number = int(current.rsplit("/", 1)[1]) + 1
        base = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(f"{base}/{number}")
        fs, pointer = self._fs(f"{base}/{number}.done")
        fs.create(pointer).close()
        for old in self._list(base):
            if old.removesuffix(".done").isdigit() and int(old.removesuffix(".done")) < number:
                fs.delete(self._fs(f"{base}/{old}")[1], True)

    def derived(self, name: str, ddl: str) -> DataFrame:
        """A table of derived rows, which may be lost; empty where there is none."""
        if not self._exists(f"{self.root}/{name}"):
            self.spark.createDataFrame([], schemas.struct(ddl)).write.parquet(f"{self.root}/{name}/0")
        return self.spark.read.schema(schemas.struct(ddl)).parquet(self._version(name))

    def replace_derived(self, name: str, df: DataFrame) -> None:
        self._replace(name, df)

    def work(self, df: DataFrame, name: str, by: str) -> DataFrame:
        """A table of a run's own, in folders by a column; ``drop_work`` deletes it."""
        path = f"{self.root}/_work/{name}"
        df.write.mode("overwrite").partitionBy(by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_work(self, name: str) -> None:
        fs, p = self._fs(f"{self.root}/_work/{name}")
        fs.delete(p, True)

    # --- extractions and courses ---
    def append_extractions(self, rows: DataFrame, batch: str | None = None) -> int:
        """Append a batch, with ids above those of the table where there is none; the number of rows.

        The batch is a folder that its mark makes visible, so a driver that is lost at any moment leaves all of it or
        nothing.  A batch of a given name is appended once: what was written without a mark is written anew, and one that has
        its mark adds no rows.  New ids follow the rows' place in the folder's tasks, so no two rows of a batch share one.
        """
        batch = batch or uuid.uuid4().hex
        fs, mark = self._fs(f"{self._marks('extractions')}/{batch}")
        if fs.exists(mark):
            return 0
        schema = schemas.struct(schemas.EXTRACTIONS)
        for name, value in (("extraction_id", F.lit(None).cast("long")), ("created_at", F.lit(None).cast("timestamp"))):
            rows = rows if name in rows.columns else rows.withColumn(name, value)
        last = self.read("extractions").agg(F.coalesce(F.max("extraction_id"), F.lit(0))).first()[0]
        rows = rows.withColumn("created_at", F.coalesce("created_at", F.current_timestamp())).withColumn("extraction_id", F.coalesce("extraction_id", F.lit(last) + 1 + F.monotonically_increasing_id()))
        folder = f"{self.root}/batches/{batch}/extractions"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("overwrite").parquet(folder)
        fs.create(mark).close()
        return self.spark.read.schema(schema).parquet(folder).count()

    def succeeded(self) -> DataFrame:
        return self.read("extractions").where("extraction_status = 'success'").select("source_path").distinct()

    def upsert_courses(self, rows: DataFrame) -> None:
        """Every column of a known code is replaced, also by null; created_at stays."""
        old = self.read("courses")
        born = old.select("kcbh", F.col("created_at").alias("_born"))
        rows = rows.join(born, "kcbh", "left").withColumn("created_at", F.coalesce("_born", "created_at")).withColumn("updated_at", F.current_timestamp()).select(*old.columns)
        self._replace("courses", R.upsert(old, rows, ["kcbh"]))

    # --- runs ---
    def create_run(self, auditors: list[str], snapshot: dict, total: int, term: str | None = None, name: str | None = None) -> int:
        now = datetime.now(UTC)
        run_id = int(now.timestamp() * 1_000_000)
        row = [(run_id, name or f"audit_{now:%Y%m%d_%H%M%S}", term, auditors, "running", total, "{}", json.dumps(snapshot, ensure_ascii=False, default=str), None, now, None, now)]
        self._put_run(self.spark.createDataFrame(row, schemas.struct(schemas.RUNS)))
        return run_id

    def _put_run(self, row: DataFrame) -> None:
        self._replace("runs", R.upsert(self.read("runs"), row, ["run_id"]))

    def run(self, run_id: int) -> dict:
        found = self.read("runs").where(F.col("run_id") == run_id).collect()
        if not found:
            raise KeyError(f"no run {run_id}")
        return found[0].asDict()

    def _move(self, run_id: int, status: str, summary: dict | None = None, **columns: object) -> None:
        """New state; the summary's keys are merged, the new ones win."""
        row = self.run(run_id) | {"status": status, "updated_at": datetime.now(UTC)} | columns
        row["summary"] = json.dumps({**json.loads(row["summary"] or "{}"), **(summary or {})}, ensure_ascii=False)
        self._put_run(self.spark.createDataFrame([tuple(row.values())], schemas.struct(schemas.RUNS)))

    def resume_run(self, run_id: int, total: int, skipped: int, pending: int) -> None:
        state = self.run(run_id)["status"]
        if state not in RESUMABLE:
            raise ValueError(f"run {run_id} is {state}")
        self._move(run_id, "running", {"resumed": True, "skipped": skipped, "pending": pending}, course_total=total, error=None)

    def complete_run(self, run_id: int, metrics: DataFrame | None = None) -> None:
        summary = {}
        if metrics is not None:
            self.save_metrics(metrics)
            summary = {r.metric_key: r.metric_value for r in metrics.limit(1000).collect()}
        self._move(run_id, "completed", summary, completed_at=datetime.now(UTC))

    def fail_run(self, run_id: int, error: str) -> None:
        self._move(run_id, "failed", error=error[:2000], completed_at=datetime.now(UTC))

    def completed_keys(self, run_id: int) -> DataFrame:
        return self.read("results").where(F.col("run_id") == run_id).select("subject_key").distinct()

    # --- audits ---
    def save_audits(self, run_id: int, results: DataFrame, findings: DataFrame, field_findings: DataFrame) -> None:
        """Append one batch of the three tables; subjects that the run has already are an error, unmarked batches invisible."""
        again = results.select("subject_key").join(self.completed_keys(run_id), "subject_key").limit(1).collect()
        if again:
            raise ValueError(f"run {run_id} has {again[0].subject_key} already")
        batch = uuid.uuid4().hex
        for name, df in zip(AUDIT_TABLES, (results, findings, field_findings), strict=True):
            schema = schemas.struct(schemas.TABLES[name])
            for text in set(df.columns) & {"reason", "message", "suggestion", "details"}:
                df = df.withColumn(text, C.customer_text(text))
            have = set(df.columns)
            df = df.withColumn("run_id", F.lit(run_id)).withColumn("result_id", F.abs(F.xxhash64(F.lit(run_id), "subject_key")))
            have |= {"run_id", "result_id"}
            df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(f"{self.root}/batches/{batch}/{name}")
        fs, mark = self._fs(f"{self.root}/_marks/{batch}")
        fs.create(mark).close()

    def save_metrics(self, metrics: DataFrame) -> None:
        rows = metrics.withColumn("updated_at", F.current_timestamp()).select("run_id", "metric_key", "metric_value", "updated_at")
        self._replace("metrics", R.upsert(self.read("metrics"), rows, ["run_id", "metric_key"]))


def _any_of(columns: list[str], words: tuple[str, ...]) -> F.Column:
    """LIKE-any of several words over several columns; null counts as no hit."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.col(c), F.lit(w)), F.lit(False)) for c in columns for w in words])


def missing_fields(field_findings: DataFrame, n: int = 10) -> DataFrame:
    """The fields that most often lack a value."""
    return R.top(field_findings, ["section", "field", "reason", "path"], n, (F.col("status") != "pass") & _any_of(["reason"], config.MISSING_WORDS))


def top_reasons(field_findings: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent reasons of what did not pass."""
    return R.top(field_findings, ["reason"], n, (F.col("status") != "pass") & (F.coalesce("reason", F.lit("")) != ""))


def review_count(field_findings: DataFrame) -> DataFrame:
    """Subjects of which a finding asks for a manual review."""
    return field_findings.where(_any_of(["reason", "message"], config.REVIEW_WORDS)).agg(F.count_distinct("result_id").alias("n"))


def model_calls(findings: DataFrame) -> DataFrame:
    """(status, n) of the failed calls in the dimensions' traces."""
    calls = findings.select(F.explode(F.from_json(F.get_json_object("llm_trace", "$.calls"), "array<struct<status:string>>")).alias("c")).select("c.status")
    return R.status_counts(calls.where(F.col("status").isin(*config.MODEL_FAILURES)), "status")


def run_metrics(results: DataFrame, findings: DataFrame, field_findings: DataFrame, run_id: int, dimensions: list[str]) -> DataFrame:
    """(run_id, metric_key, metric_value JSON): overall and dimensions' pass rates, top reasons and missing fields,
    subjects for review, failed model calls and their sum.  Each value is made of a few aggregated rows."""
    own = lambda df: df.where(F.col("run_id") == run_id)
    res, dims, fields = own(results), own(findings), own(field_findings)
    listed = lambda df, order: df.agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct(*order, F.struct(*df.columns).alias("row")))), lambda x: x["row"])).alias("metric_value"))
    total, passed = res.agg(F.count("*").alias("total")), R.all_pass(res, dims, "result_id", dimensions).agg(F.count("*").alias("pass_count"))
    overall = total.crossJoin(passed).withColumns({"fail_count": F.greatest(F.col("total") - F.col("pass_count"), F.lit(0)), "pass_rate": C.rate("pass_count", "total"), "dimension_count": F.lit(len(dimensions)), "dimensions": F.array(*map(F.lit, dimensions))})  # one row each
    by_wd = R.dimension_totals(dims, dimensions)
    rates = by_wd.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("wd", F.struct("total", "pass_count", "fail_count", "pass_rate"))))).alias("metric_value"))
    reasons = top_reasons(fields).select("reason", F.col("n").alias("count"))
    missing = missing_fields(fields).select("section", "field", "path", "reason", F.col("n").alias("count"))
    calls = model_calls(dims)
    by_status = calls.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n"))))).alias("metric_value"))
    most = -F.col("count")
    parts = {
        "overall_pass_rate": overall.select(F.to_json(F.struct(*overall.columns)).alias("metric_value")), "dimension_pass_rates": rates,
        "reason_top10": listed(reasons, [most.alias("o"), "reason"]), "missing_field_top10": listed(missing, [most.alias("o"), "section", "field", "reason", "path"]),
        "manual_review_course_count": review_count(fields).select(F.col("n").cast("string").alias("metric_value")),
        "llm_exception_count": calls.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("string").alias("metric_value")), "llm_status_counts": by_status,
    }
    rows = [df.select(F.lit(run_id).cast("long").alias("run_id"), F.lit(k).alias("metric_key"), "metric_value") for k, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def write_csv(df: DataFrame, path: str) -> None:
    """A diagnostic of a few rows as one CSV file that begins with a byte-order mark."""
    first = df.columns[0]
    df.coalesce(1).withColumnRenamed(first, "\ufeff" + first).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


class JsonLines(logging.Formatter):
    """Log records as one JSON object a line."""

    def format(self, record: logging.LogRecord) -> str:
        own = {"time": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            own["error"] = self.formatException(record.exc_info)
        return json.dumps(own | getattr(record, "fields", {}), ensure_ascii=False)


def logger(name: str = "planforge", level: int = logging.INFO) -> logging.Logger:
    found = logging.getLogger(name)
    if not found.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(JsonLines())
        found.addHandler(handler)
        found.setLevel(level)
    return found
