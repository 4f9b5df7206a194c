"""Serial numbers: a distributed row number, the master serial and keyed claim lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import packing
from ..functions.codes import null
from ..work import CODEC, fresh_path, remove

# Source tags and the leading digits of their serial ranges.
TREATMENT, DIAGNOSIS, PRESCRIPTION, SCREENING, ELIGIBILITY = "130", "140", "160", "GJT", "JKT"
LEADING = {TREATMENT: 3, DIAGNOSIS: 4, PRESCRIPTION: 6, SCREENING: 8, ELIGIBILITY: 9}
# End of fixed values.

SEQ_COLUMNS = (
    "master_seq",
    "source_table",
    "person_id",
    "key_seq",
    "seq_no",
    "hchk_year",
    "stnd_y",
)


def _header(t20: DataFrame) -> DataFrame:
    """The header columns claim lines need; the header's date is renamed."""
    return t20.select(
        "key_seq",
        "person_id",
        "form_cd",
        "in_pat_cors_type",
        "vscn",
        "sub_sick",
        F.col("recu_fr_dt").alias("header_dt"),
    )


@dataclass(frozen=True)
class SerialRanges:
    """Serial ranges per source: claim lines start at d * 10**digits, yearly rows two digits wider.

    ``digits=9`` gives 3000000001.., 800000000001... A source with 10**digits rows or more
    would run into the next range, so larger data needs more digits (12 holds a trillion
    lines and event and screening ids still fit a bigint).
    """

    digits: int = 9

    def base(self, source: str) -> int:
        width = self.digits + 2 if source in (SCREENING, ELIGIBILITY) else self.digits
        return LEADING[source] * 10**width

    def size(self, source: str) -> int:
        return 10 ** (self.digits + 2 if source in (SCREENING, ELIGIBILITY) else self.digits)

    def check(self, source: str, rows: int) -> None:
        if rows >= self.size(source):
            raise ValueError(
                f"{rows} rows of source {source} do not fit serial ranges of {self.digits} digits"
            )

    def holds_event(self, event, source: str):
        """Whether an event id was built from a serial of this source (a plain range filter)."""
        low = self.base(source)
        return event.between(low * 10, (low + self.size(source)) * 10 - 1)


RANGES = SerialRanges()


def _in_order(parts: list[Row]) -> bool:
    """Whether each partition ends before the next begins, by their _first and _last keys."""

    def key(values: Row) -> list[tuple]:
        return [(v is not None, v if v is not None else 0) for v in values]

    return all(key(a["_last"]) < key(b["_first"]) for a, b in zip(parts, parts[1:]))


def write_numbered(
    df: DataFrame, order_by: list[str], path: str, ranged: tuple[str, ...] = ()
) -> int:
    """Store the rows so that :func:`read_numbered` can number them; returns their count.

    Rows are range-partitioned, sorted and written once with their position inside the
    partition. A small table next to them holds how many rows come before each partition.
    ``ranged`` names the first columns of the order if the rows lie in ranges of them already:
    they are then not shuffled again. Should they not lie so, they are.
    """
    spark = df.sparkSession
    rows = (
        (df if ranged else df.repartitionByRange(*order_by))
        .sortWithinPartitions(*order_by)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # Range bounds come from a sample: positions are only meaningful once they are written.
    rows.write.mode("overwrite").parquet(f"{path}/rows", compression=CODEC)
    # One row per range partition comes to the driver, whatever the number of rows.
    group = F.struct(*(ranged or order_by[:1]))
    sizes = (
        spark.read.schema(rows.schema)
        .parquet(f"{path}/rows")
        .groupBy(F.shiftright("_row", 33).alias("_part"))
        .agg(F.count("*").alias("_n"), F.min(group).alias("_first"), F.max(group).alias("_last"))
        .orderBy("_part")
        .collect()
    )
    if ranged and not _in_order(sizes):
        return write_numbered(df, order_by, path)
    starts, total = [], 0
    for size in sizes:
        starts.append((size["_part"], total))
        total += size["_n"]
    starts = spark.createDataFrame(starts, "_part bigint, _start bigint").coalesce(1)
    starts.write.mode("overwrite").parquet(f"{path}/starts", compression=CODEC)
    return total


def read_numbered(spark: SparkSession, path: str, name: str, base: int = 0) -> DataFrame:
    """The stored rows with ``name`` = base + 1..n in the order they were written for.

    The number is computed while scanning: the broadcast side has one row per partition.
    """
    rows = spark.read.parquet(f"{path}/rows")
    starts = spark.read.parquet(f"{path}/starts")
    within = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        rows.withColumn("_part", F.shiftright("_row", 33))
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within + F.lit(base + 1))
        .drop("_part", "_start", "_row")
    )


def ranked(
    df: DataFrame, order_by: list[str], name: str, label: str = "ranked", path: str | None = None,
    ranged: tuple[str, ...] = (),
) -> DataFrame:
    """``row_number() over (order by ...)`` of a whole table without a single-task window.

    ``order_by`` should be a total order, or rows that tie on it be interchangeable. The rows
    are stored under ``path``, which a caller that copies them on may remove afterwards.
    """
    path = path or fresh_path(df.sparkSession, label)
    write_numbered(df, order_by, path, ranged)
    return read_numbered(df.sparkSession, path, name)


def _serial(
    df: DataFrame,
    order_by: list[str],
    source: str,
    ranges: SerialRanges,
    path: str | None,
    issued: int = 0,
) -> DataFrame:
    path = path or fresh_path(df.sparkSession, f"seq-{source}")
    ranges.check(source, issued + write_numbered(df, order_by, path))
    return read_numbered(df.sparkSession, path, "master_seq", ranges.base(source) + issued)


def unsent(keys: DataFrame) -> DataFrame:
    """Keys of a large table, to be joined without a broadcast.

    The planner takes a column's size from that of the file, by its share of the width: compressed
    keys of ten million claims look small enough to be gathered on the driver. Every join on persons,
    claims, lines or their events says so; vocabulary, fixed rules and counts per partition do not grow.
    """
    return keys.hint("merge")


def counted_claims(lines: DataFrame, t20: DataFrame) -> DataFrame:
    """(key_seq, _n): the number of lines of each claim that has a header."""
    counts = lines.groupBy("key_seq").agg(F.count("*").alias("_n"))
    return counts.join(unsent(t20.select("key_seq")), "key_seq")


def claim_offsets(lines: DataFrame, t20: DataFrame, path: str) -> tuple[DataFrame, int]:
    """(key_seq, _offset): the lines of all earlier claims that have a header; and their number.

    One row per claim is ordered and summed, whatever the width of the lines.
    """
    spark = lines.sparkSession
    rows = (
        counted_claims(lines, t20)
        .repartitionByRange("key_seq")
        .sortWithinPartitions("key_seq")
        .withColumn("_row", F.monotonically_increasing_id())
    )
    rows.write.mode("overwrite").parquet(path, compression=CODEC)
    part = F.shiftright("_row", 33)
    stored = spark.read.schema(rows.schema).parquet(path).withColumn("_part", part)
    # One row per range partition comes to the driver.
    sizes = stored.groupBy("_part").agg(F.sum("_n").alias("_n")).orderBy("_part").collect()
    starts, total = [], 0
    for size in sizes:
        starts.append((size["_part"], total))
        total += size["_n"]
    before = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_n").over(before), F.lit(0))
    offsets = (
        stored.withColumn("_within", within)
        .join(F.broadcast(spark.createDataFrame(starts, "_part bigint, _start bigint")), "_part")
        .select("key_seq", (F.col("_start") + F.col("_within")).alias("_offset"))
    )
    return offsets, total


def keyed_lines(
    lines: DataFrame,
    t20: DataFrame,
    source: str,
    ranges: SerialRanges = RANGES,
    path: str | None = None,
    issued: int = 0,
    partition_by: dict[str, Column] | None = None,
) -> DataFrame:
    """Claim lines with their header columns and master serial, stored once under ``path``.

    Serials follow those ``issued`` before; ``partition_by`` names columns of the stored layout.
    Lines without a header get no serial. Serials follow (key_seq, seq_no): the lines of earlier
    claims plus the place in the claim, so lines move once, to their header and claim. A source
    that does not fit its range of serials stops here, before any line is written. Every event
    operator reads this stage, so the joins line-header and line-serial happen once and not
    once per target table. The lines of one claim are ordered in one task: a claim is one
    visit to one institution, its lines are numbered by hand and far below any task's limit.
    """
    spark = lines.sparkSession
    path = path or fresh_path(spark, f"keyed-{source}")
    claims = fresh_path(spark, f"claims-{source}")
    offsets, total = claim_offsets(lines, t20, claims)
    ranges.check(source, issued + total)
    header = _header(t20).join(unsent(offsets), "key_seq")
    place = F.row_number().over(Window.partitionBy("key_seq").orderBy("seq_no"))
    keyed = (
        lines.join(unsent(header), "key_seq")
        .withColumn("master_seq", F.col("_offset") + place + F.lit(ranges.base(source) + issued))
        .drop("_offset")
    )
    layout = partition_by or {}
    keyed.withColumns(layout).write.mode("overwrite").partitionBy(*layout).parquet(path, compression=CODEC)
    remove(spark, claims)
    return read_keyed_lines(spark, path)


def read_keyed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Keyed lines stored by an earlier run."""
    return spark.read.parquet(path)


def _by_type(df: DataFrame, *without: str) -> tuple[list[str], list[str]]:
    """The text columns and the others."""
    kept = [f for f in df.schema if f.name not in without]
    texts = [f.name for f in kept if f.dataType.typeName() == "string"]
    return texts, [f.name for f in kept if f.name not in texts]


def sources_by_claim(sources: dict[str, DataFrame], t20: DataFrame) -> DataFrame:
    """Lines of several sources (tag and lines) with their header, in ranges of claims.

    Headers and lines move once, their texts as one text a row: a range holds the headers of its
    claims, and the lines of each source in the order of their serials. The columns of a source are a
    struct of their own. The rows of one claim meet in one task, as in :func:`keyed_lines`.
    """
    header = _header(t20)
    texts, others = _by_type(header, "key_seq")
    claim = F.struct(*others, packing.packed(texts).alias("_head"))
    rows = header.select("key_seq", claim.alias("_claim"), null("string").alias("_source"))
    own = {}
    for source, lines in sources.items():
        line_texts, line_others = _by_type(lines, "key_seq", "seq_no")
        # A struct for each source: rows carry the columns of their own source only.
        numbers = [F.struct(*line_others).alias(f"_{source}")] if line_others else []
        part = lines.select(
            "key_seq", "seq_no", *numbers, packing.packed(line_texts).alias("_line"),
            F.lit(source).alias("_source"),
        )
        rows = rows.unionByName(part, allowMissingColumns=True)
        fields = [*packing.unpacked(F.col("_texts"), line_texts), *[f"_{source}.{c}" for c in line_others]]
        own[f"_{source}"] = F.when(F.col("_source") == source, F.struct(*fields))
    # Headers have no source, so they come first in their claim.
    before = Window.partitionBy("key_seq").orderBy(F.col("_source").asc_nulls_first())
    return (
        rows.where(F.col("key_seq").isNotNull())
        .repartitionByRange("key_seq")
        .withColumn("_claims", F.collect_list("_claim").over(before))
        .where(F.col("_source").isNotNull())
        .select("*", F.inline("_claims"))
        .sortWithinPartitions("_source", "key_seq", "seq_no")
        .withColumns({"_texts": packing.parts(F.col("_line")), "_heads": packing.parts(F.col("_head"))})
        .select(
            "_source", "key_seq", "seq_no", *[struct.alias(name) for name, struct in own.items()],
            *others, *packing.unpacked(F.col("_heads"), texts),
        )
    )


def write_keyed_sources(
    sources: dict[str, DataFrame], t20: DataFrame, path: str, ranges: SerialRanges = RANGES
) -> None:
    """The frames of :func:`keyed_lines` of several sources (tag and lines) in one pass.

    Lines are stored by source with their position; a small table next to them holds what makes
    positions serials. Lines without a header are left out. A source that does not fit its range
    of serials stops here and leaves no table to read.
    """
    spark = t20.sparkSession
    rows = sources_by_claim(sources, t20)
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    keyed.write.mode("overwrite").partitionBy("_source").parquet(f"{path}/rows", compression=CODEC)
    # A row for each source and range comes to the driver.
    parts = (
        spark.read.schema(keyed.schema)
        .parquet(f"{path}/rows")
        .groupBy("_source", F.shiftright("_row", 33).alias("_part"))
        .agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
        .orderBy("_source", "_part")
        .collect()
    )
    starts, totals = [], dict.fromkeys(sources, 0)
    for part in parts:
        source = part["_source"]
        first = ranges.base(source) + totals[source] + 1
        # A serial is the row's position and this difference.
        starts.append((source, part["_part"], first - part["_first"]))
        totals[source] += part["_n"]
    for source, total in totals.items():
        ranges.check(source, total)
        if not total:
            none = spark.createDataFrame([], keyed.drop("_source").schema)
            none.write.mode("overwrite").parquet(f"{path}/rows/_source={source}")
    starts = spark.createDataFrame(starts, "_source string, _part bigint, _shift bigint").coalesce(1)
    starts.write.mode("overwrite").parquet(f"{path}/starts")


def read_keyed_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Keyed lines of one source, their serials computed while scanning."""
    starts = spark.read.parquet(f"{path}/starts").where(F.col("_source") == source).drop("_source")
    rows = spark.read.parquet(f"{path}/rows/_source={source}")
    kept = [c for c in rows.columns if not c.startswith("_")]
    return (
        rows.withColumn("_part", F.shiftright("_row", 33))
        .join(F.broadcast(starts), "_part")
        .select(*kept, f"_{source}.*", (F.col("_row") + F.col("_shift")).alias("master_seq"))
    )


def join_master(lines: DataFrame, t20: DataFrame, seq: DataFrame, source: str) -> DataFrame:
    """The frame of :func:`keyed_lines` rebuilt from a stored serial table (subset reruns)."""
    serial = seq.where(F.col("source_table") == source).select(
        "master_seq", "key_seq", "seq_no", "person_id"
    )
    return lines.join(unsent(serial), ["key_seq", "seq_no"]).join(
        unsent(_header(t20)), ["key_seq", "person_id"]
    )


def yearly_master(
    df: DataFrame, year: str, source: str, ranges: SerialRanges = RANGES, issued: int = 0
) -> DataFrame:
    """Serial of each distinct (year, person) of the screening or eligibility table."""
    years = df.select(year, "person_id").distinct()
    return _serial(years, [year, "person_id"], source, ranges, None, issued)


def seq_master(
    k30: DataFrame, k40: DataFrame, k60: DataFrame, gj: DataFrame, jk: DataFrame
) -> DataFrame:
    """The serial table of all five sources from the keyed frames and yearly serials."""

    def line_part(frame: DataFrame, source: str) -> DataFrame:
        return frame.select(
            "master_seq",
            F.lit(source).alias("source_table"),
            "person_id",
            "key_seq",
            "seq_no",
            null("string").alias("hchk_year"),
            null("string").alias("stnd_y"),
        )

    def year_part(frame: DataFrame, source: str, screening: bool) -> DataFrame:
        return frame.select(
            "master_seq",
            F.lit(source).alias("source_table"),
            "person_id",
            null("bigint").alias("key_seq"),
            null("int").alias("seq_no"),
            (F.col("hchk_year") if screening else null("string")).cast("string").alias("hchk_year"),
            (null("string") if screening else F.col("stnd_y")).cast("string").alias("stnd_y"),
        )

    parts = [
        line_part(k30, TREATMENT),
        line_part(k40, DIAGNOSIS),
        line_part(k60, PRESCRIPTION),
        year_part(gj, SCREENING, True),
        year_part(jk, ELIGIBILITY, False),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*SEQ_COLUMNS)


def ranked_within(df: DataFrame, group: str, order_by: list[str], name: str) -> DataFrame:
    """``row_number()`` within each group for groups of any size.

    The table is ranked as a whole, then the first rank of the group is taken off: a group
    that holds much of the table spreads over many range partitions, and the join back on
    the group is an equi-join that AQE can split.
    """
    numbered = ranked(df, [group, *order_by], "_rank", f"within-{group}")
    first = numbered.groupBy(group).agg(F.min("_rank").alias("_first"))
    return (
        numbered.join(unsent(first), group)
        .withColumn(name, (F.col("_rank") - F.col("_first") + 1).cast("int"))
        .drop("_rank", "_first")
    )


def with_identity(
    df: DataFrame, order_by: list[str], name: str, path: str | None = None,
    ranged: tuple[str, ...] = (),
) -> DataFrame:
    """Prefix a 1..n id in the given total order (era ids and identity columns)."""
    numbered = ranked(df, order_by, name, name, path, ranged)
    return numbered.select(name, *df.columns)
