"""Paged JSON services, their stored captures, and manifests of works."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Answers that are worth another try.
RETRIED = (408, 429, 500, 502, 503, 504)


def fetch(url: str, tries: int = 3, pause: float = 0.25, timeout: float = 30.0) -> bytes:
    """The body of a page; timeouts and busy answers are tried again after pauses that double."""
    from urllib import error, request

    for n in range(tries + 1):
        try:
            with request.urlopen(url, timeout=timeout) as answer:
                return answer.read()
        except error.HTTPError as e:
            if e.code not in RETRIED or n == tries:
                raise
        except (error.URLError, TimeoutError):
            if n == tries:
                raise
        time.sleep(pause * 2**n)
    raise AssertionError


class Pages(InputPartition):
    def __init__(self, first: int, step: int):
        self.first, self.step = first, step


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.limit = options["url"], int(options.get("limit", 100))
        self.lanes, self.envelope = int(options.get("lanes", 4)), options.get("envelope", "results")

    def partitions(self) -> list[Pages]:
        return [Pages(i, self.lanes) for i in range(self.lanes)]

    def read(self, part: Pages) -> Iterator[tuple]:
        # a lane takes every lanes-th page and ends at its first short page
        page = part.first
        while True:
            skip = page * self.limit
            join = "&" if "?" in self.url else "?"
            records = json.loads(fetch(f"{self.url}{join}limit={self.limit}&skip={skip}"))[self.envelope]
            for i, r in enumerate(records):
                yield page, f"/{self.envelope}/{i}", json.dumps(r, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
            if len(records) < self.limit:
                return
            page += part.step


class PagedSource(DataSource):
    """``spark.read.format("paged_json")``: rows (page, pointer, record) of a service that takes limit and skip.

    Options: url, limit (100), lanes (4, read side by side), envelope (results).
    """

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, pointer string, record string"

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def harvest(spark: SparkSession, url: str, limit: int = 100, lanes: int = 4) -> DataFrame:
    spark.dataSource.register(PagedSource)
    return spark.read.format("paged_json").option("url", url).option("limit", limit).option("lanes", lanes).load()


def replay(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Rows (skip, pointer, record) of stored pages, or an error.

    ``manifest``: (file, skip, limit, count, sha256), a row for each page. A page set is complete if every file
    has its hash, pages follow one another without gap or overlap, every page but the last is full, and the
    counts agree with the records found.
    """
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content", F.sha2("content", 256).alias("found"))
    pages = manifest.join(files, "file", "left")
    # a table without gaps has one chain of pages: the next page starts where this one ends
    following = manifest.select(F.col("skip").alias("next_skip"))
    chained = pages.join(following, F.col("skip") + F.col("limit") == F.col("next_skip"), "left")
    records = F.from_json(F.col("content").cast("string"), "results array<string>")["results"]
    checked = chained.withColumn("records", records)
    bad = checked.agg(
        F.count_if(F.col("found").isNull()).alias("missing"), F.count_if(F.col("found") != F.col("sha256")).alias("changed"),
        F.count_if(F.size("records") != F.col("count")).alias("miscounted"), F.count_if(F.col("next_skip").isNull()).alias("ends"),
        F.count_if(F.col("next_skip").isNotNull() & (F.col("count") < F.col("limit"))).alias("short"), F.min("skip").alias("first"), F.count(F.lit(1)).alias("n"),
    ).first()
    if not bad["n"] or bad["missing"] or bad["changed"] or bad["miscounted"] or bad["short"] or bad["ends"] != 1 or bad["first"] != 0:
        raise ValueError(f"incomplete page set: {bad.asDict()}")
    return checked.select("skip", F.posexplode("records").alias("pos", "record")).select("skip", F.concat(F.lit("/results/"), F.col("pos").cast("string")).alias("pointer"), "record")


def choose_capture(runs: DataFrame, pinned: dict[str, str] | None = None, authoritative: bool = True) -> DataFrame:
    """The run to read for each endpoint: the pinned one, else the last completed (and ``authoritative``: complete and
    unfiltered) one; ties by run id. Rows as in ``runs``: (run, endpoint, completed_at, complete, filtered)."""
    pins = runs.sparkSession.createDataFrame(list((pinned or {}).items()), "endpoint string, __pin string")  # a row for each pinned endpoint
    x = runs.join(F.broadcast(pins), "endpoint", "left")
    ok = F.col("completed_at").isNotNull()
    if authoritative:
        ok &= F.col("complete") & ~F.col("filtered")
    x = x.where(F.when(F.col("__pin").isNotNull(), F.col("run") == F.col("__pin")).otherwise(ok))
    place = F.row_number().over(Window.partitionBy("endpoint").orderBy(F.desc("completed_at"), F.desc("run")))
    return x.withColumn("__place", place).where("__place = 1").drop("__place", "__pin")


def batches(works: list[tuple[str, int]], max_works: int, max_bytes: int) -> list[list[str]]:
    """Works of a locked manifest in order, greedily in batches; one work above ``max_bytes`` is an error.

    The rule is sequential and its input a manifest, so it runs on the driver.
    """
    out, size = [], 0
    for name, n in works:
        if n > max_bytes:
            raise ValueError(f"{name} alone has {n} bytes")
        if not out or len(out[-1]) == max_works or size + n > max_bytes:
            out.append([])
            size = 0
        out[-1].append(name)
        size += n
    return out


def strict_json(text: str):
    """A decision or registry file; an object that names a key twice is an error."""
    def pairs(items):
        names = [k for k, _ in items]
        if len(set(names)) < len(names):
            raise ValueError(f"repeated key among {names}")
        return dict(items)

    return json.loads(text, object_pairs_hook=pairs)


def registry(spark: SparkSession, path: str, schema: str, envelope: str) -> DataFrame:
    """Rows of the array ``envelope`` of a registry file that names no key twice; the file is a bounded, reviewed list."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return spark.createDataFrame([tuple(r.get(f.split()[0]) for f in schema.split(",")) for r in strict_json(text)[envelope]], schema)


def month_windows(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Rows (s, e), calendar months from the first to the last day, cut at both ends: windows below a service's row cap."""
    x = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(first).cast("date"), "month"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("m"))
    return x.select(F.greatest("m", F.lit(first).cast("date")).alias("s"), F.least(F.last_day("m"), F.lit(last).cast("date")).alias("e"))


def documents_by_hash(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """Rows (uri, sha256, content, status) of stored documents against (uri, sha256): present, changed or missing."""
    files = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("sha256"), "content").dropDuplicates(["sha256"])
    named = F.regexp_extract("uri", r"([^/]+)/?$", 1)
    x = expected.join(files, "sha256", "left").withColumn("__uri", F.regexp_extract(F.col("content").cast("string"), r'<FRBRthis\s+value="([^"]*)"', 1))
    status = F.when(F.col("content").isNull(), "missing").when((F.col("__uri") != "") & ~F.endswith(F.col("__uri"), named), "other document").otherwise("present")
    return x.select("uri", "sha256", "content", status.alias("status"))


def decode_pointer(segment: Column) -> Column:
    """One segment of a JSON pointer, unescaped."""
    return F.replace(F.replace(segment, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))
