"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets a global number, the number goes through a keyed permutation of [0, n), and the
permuted place gives shard and slot by arithmetic: shard = place % shards, slot = place // shards.
So shards differ by one row at most and slots have no gaps. DataFrame functions only.

Defined cases: a null id counts as 0 for its bucket and sorts first; a null text has 0 bytes and
the checksum of no bytes; repeated rows are separate rows; an empty table gives an empty result;
columns of any other name are carried along by `sharded`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Half-rounds of the Feistel network: even ones change the left half, odd ones the right.
HALF_ROUNDS = 8
#: A prime below 2**31: products of two residues stay inside a signed long.
PRIME = 2147483647
SPREAD = 48271
#: Buckets in which rows are numbered; the only table that meets in one task has a row for each.
BUCKETS = 4096
#: Passes through the network that every row may take before the rare longer walk.
WALKS = 3


def half_round_keys(seed: int) -> list[int]:
    return [(seed * 7919 + k * 104729 + 12345) % 1000003 for k in range(HALF_ROUNDS)]


def mix_sql(x: str, key: str) -> str:
    """A spread of a number in [0, PRIME) over the same range, in SQL that any engine reads alike."""
    y = f"(({x} + {key}) % {PRIME})"
    return f"(({y} * {y} % {PRIME} * {SPREAD} + {y}) % {PRIME})"


def bucket_sql(columns: list[str], buckets: int) -> str:
    """A bucket by whole-number columns; null counts as 0."""
    x = "17"
    for c in columns:
        known = f"coalesce({c}, 0)"
        x = mix_sql(f"(({known} % {PRIME} + {PRIME}) % {PRIME})", x)
    return f"({x} % {buckets})"


def row_numbers(df: DataFrame, order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Add `row` in [0, n) without gaps, and `n_rows`.

    Rows are numbered by (bucket of the first two columns of `order`, then all of those columns); rows equal in
    all of them may change places, which no result shows. Two passes: counts of the buckets (a row
    for each, so the running total is bounded by `buckets`), then a rank inside each bucket. A second column
    parts rows that have the same first one.
    """
    bucketed = df.withColumn("_bucket", F.expr(bucket_sql([f"`{c}`" for c in order[:2]], buckets)))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_bucket").alias("_at"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("n_rows"),
    )
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    return (
        bucketed.withColumn("_rank", rank - 1)
        .join(F.broadcast(offsets), F.col("_bucket") == F.col("_at"))
        .withColumn("row", F.col("_before") + F.col("_rank"))
        .drop("_bucket", "_at", "_rank", "_before")
    )


def permuted(df: DataFrame, seed: int, row: str = "row", n: str = "n_rows", out: str = "place") -> DataFrame:
    """Add `out`: the place of `row` under a keyed permutation of [0, n).

    The network works on the cells of a grid of a x b, a = ceil(sqrt n) and b = ceil(n / a), so
    fewer than a cells lie outside [0, n). A place outside goes through the network again until it
    lands inside, which is a permutation of [0, n). Three walks serve almost every row; the few
    others walk on, up to as often as there are cells outside, the longest walk there can be.
    """
    keys = ", ".join(f"struct({k}L as k, {i % 2} as side)" for i, k in enumerate(half_round_keys(seed)))
    network = (
        f"aggregate(array({keys}), struct(x div _b as l, x % _b as r), (s, h) -> struct("
        f"if(h.side = 0, (s.l + {mix_sql('s.r', 'h.k')}) % _a, s.l) as l, "
        f"if(h.side = 1, (s.r + {mix_sql('s.l', 'h.k')}) % _b, s.r) as r), s -> s.l * _b + s.r)"
    )
    walk = f"(x, i) -> if(i > 1 and x < `{n}`, x, {network})"
    more = f"(x, i) -> if(x < `{n}`, x, {network})"
    return (
        df.withColumn("_a", F.expr(f"cast(ceil(sqrt(cast(`{n}` as double))) as bigint)"))
        .withColumn("_b", F.expr(f"(`{n}` + _a - 1) div _a"))
        .withColumn("_x", F.expr(f"aggregate(sequence(1, {WALKS}), cast(`{row}` as bigint), {walk})"))
        .withColumn(out, F.expr(f"if(_x < `{n}`, _x, aggregate(sequence(1L, _a * _b - `{n}`), _x, {more}))"))
        .drop("_a", "_b", "_x")
    )


def sharded(df: DataFrame, shards: int, order: list[str], seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """df with `shard` (int) and `slot` (long): a reproducible shuffle whose shards differ by one row at most.

    Where a row goes can be computed again from its number alone. Columns of df keep their names and values; one that
    is called shard or slot itself is found under that name with _before behind it.
    """
    names = df.columns
    inner = [c if c in order else f"extra_column_{k}" for k, c in enumerate(names)]
    placed = permuted(row_numbers(df.toDF(*inner), order, buckets), seed)
    kept = [F.col(f"`{a}`").alias(f"{b}_before" if b in ("shard", "slot") else b) for a, b in zip(inner, names, strict=True)]
    return placed.select(*kept, F.expr(f"cast(place % {shards} as int)").alias("shard"), F.expr(f"place div {shards}").alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, order: list[str], seed: int = 0) -> None:
    """Write each shard as a folder `shard=N` whose files, in order of name, hold the rows in slot order: a large shard has several tasks."""
    out = sharded(df, shards, order, seed)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, size and text_crc32 of each document: the text itself is not shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )


def shard_documents(documents: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    out: Column = F.lit(None).cast("int")
    return sharded(measured(documents), shards, ["doc_id", "text_crc32", "size"], seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", out.alias("grown_shard")
    )


def shard_sql(shards: int = 40, seed: int = 0, buckets: int = BUCKETS) -> str:
    """The same in DuckDB: numbered rows, then a recursive walk through the network."""
    cols = []
    left, right = "l0", "r0"
    for i, k in enumerate(half_round_keys(seed)):
        if i % 2 == 0:
            new = f"l{i + 1}"
            cols.append(f"({left} + {mix_sql(right, str(k))}) % a AS {new}")
            left = new
        else:
            new = f"r{i + 1}"
            cols.append(f"({right} + {mix_sql(left, str(k))}) % b AS {new}")
            right = new
    steps = ", ".join(cols)
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, {crc32_sql("coalesce(text, '')")} AS text_crc32 FROM documents
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY {bucket_sql(["doc_id", "text_crc32"], buckets)}, doc_id NULLS FIRST, text_crc32, size) - 1 AS num,
    count(*) OVER () AS n FROM sized
), grid AS (
  SELECT *, cast(ceil(sqrt(cast(n AS DOUBLE))) AS BIGINT) AS a FROM numbered
), grid2 AS (SELECT *, (n + a - 1) // a AS b FROM grid
), walk(num, n, a, b, x, i) AS (
  SELECT num, n, a, b, num AS x, 0 AS i FROM grid2
  UNION ALL
  SELECT num, n, a, b, {left} * b + {right} AS x, i + 1 FROM (
    SELECT *, x // b AS l0, x % b AS r0, {steps} FROM walk WHERE i = 0 OR x >= n) w
)
SELECT g.doc_id, cast(g.size AS BIGINT) AS size, cast(g.text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
  cast(w.x % {shards} AS INTEGER) AS shard, cast(w.x // {shards} AS BIGINT) AS slot, cast(NULL AS INTEGER) AS grown_shard
FROM grid2 g JOIN walk w ON g.num = w.num WHERE w.i > 0 AND w.x < w.n"""


#: The reversed polynomial of CRC-32 (fixed value).
CRC_POLYNOMIAL = 0xEDB88320


def crc32_sql(text: str) -> str:
    """CRC-32 in DuckDB, which has no function for it: half a byte at a time, the low half first."""
    table = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (CRC_POLYNOMIAL if x & 1 else 0)
        table.append(x)
    value = "strpos('0123456789ABCDEF', p[1]) * 16 + strpos('0123456789ABCDEF', p[2]) - 17"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: ({value})::BIGINT)"
    half = f"xor({{c}} >> 4, {table}[xor({{c}}, {{x}}) % 16 + 1])"
    step = half.format(c=half.format(c="c", x="x"), x="(x >> 4)")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, x: {step}), 4294967295::BIGINT)"
