"""Uniform sharding with exact shard sizes by a communication matrix.

Rows are dealt to virtual partitions by a hash.  Given the partitions' row
counts and the exact shard sizes (equal up to one row), the matrix of how
many rows each partition sends to each shard is drawn from the
multivariate hypergeometric law that a uniform shuffle induces.  Each
partition permutes its rows locally and cuts them by its matrix row, the
rows are exchanged, and each shard is permuted again, which gives the
slots.  All of it is SQL and DataFrame functions.

The matrix is drawn by halving: a node holds a range of partitions and the
shard capacities that range must fill; its left half's share is drawn
shard by shard (a hypergeometric count given what is left), the right half
takes the rest.  A count is drawn by inversion over weights relative to
the mode, built from the ratio of neighbouring probabilities, out to 12
standard deviations (or the end of the support).  All draws are functions
of the seed and the node, so a recomputed task draws the same.

Orders within partitions and shards follow a hash of the seed and the
whole row; rows equal in every column are interchangeable.  Null keys and
texts are hashed as such; an empty table gives no rows.  Input columns
named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: Rows that one virtual partition, or one stretch of a shard, holds on average.
PARTITION_ROWS = 200_000
#: Virtual partitions at least.
MIN_PARTITIONS = 64


def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _hypergeometric(total: str, marked: str, drawn: str, u: str) -> str:
    """SQL for a hypergeometric count by inversion of ``u`` in [0, 1): the
    marked rows among ``drawn`` of ``total`` rows, ``marked`` of them marked."""
    up = "(g.hits - a.k) * (g.take - a.k) / ((a.k + 1D) * (g.pop - g.hits - g.take + a.k + 1D))"
    down = "a.k * (g.pop - g.hits - g.take + a.k) / ((g.hits - a.k + 1D) * (g.take - a.k + 1D))"
    first = "named_struct('k', m.mode, 'w', 1D, 'sum', 0D)"

    def walk(width: str, ratio: str, by: str) -> str:
        step = f"named_struct('k', a.k {by} 1D, 'w', a.w * {ratio}, 'sum', a.sum + a.w * {ratio})"
        return f"aggregate(if({width} < 1, array(), sequence(1, {width})), {first}, (a, i) -> {step}).sum"

    def search(width: str, ratio: str, by: str, target: str) -> str:
        start = "named_struct('k', m.mode, 'w', 1D, 'sum', 0D, 'hit', m.mode, 'over', false)"
        now = f"a.sum + a.w * {ratio}"
        step = f"if(a.over, a, named_struct('k', a.k {by} 1D, 'w', a.w * {ratio}, 'sum', {now}, 'hit', a.k {by} 1D, 'over', {now} > {target}))"
        return f"aggregate(if({width} < 1, array(), sequence(1, {width})), {start}, (a, i) -> {step}).hit"

    pick = f"case when t.at < 1D then m.mode when t.at < 1D + t.up then {search('m.above', up, '+', 't.at - 1D')} else {search('m.below', down, '-', 't.at - 1D - t.up')} end"
    sums = _let("z", f"named_struct('up', {walk('m.above', up, '+')}, 'down', {walk('m.below', down, '-')})", f"named_struct('up', z.up, 'at', {u} * (1D + z.up + z.down))")
    body = _let("t", sums, pick)
    reach = "cast(ceil(12 * sqrt(g.take * g.hits / g.pop * (1D - g.hits / g.pop) * (g.pop - g.take) / greatest(g.pop - 1D, 1D))) + 30 as bigint)"
    mode = "least(greatest(floor((g.take + 1D) * (g.hits + 1D) / (g.pop + 2D)), greatest(0D, g.take + g.hits - g.pop)), least(g.take, g.hits))"
    bounds = _let(
        "o",
        f"named_struct('mode', cast({mode} as double), 'reach', {reach})",
        "named_struct('mode', o.mode, 'above', least(o.reach, cast(least(g.take, g.hits) - o.mode as bigint)), 'below', least(o.reach, cast(o.mode - greatest(0D, g.take + g.hits - g.pop) as bigint)))",
    )
    given = f"named_struct('pop', cast({total} as double), 'hits', cast({marked} as double), 'take', cast({drawn} as double))"
    drawn_count = _let("g", given, _let("m", bounds, body))
    return f"if({drawn} <= 0 or {marked} <= 0, 0L, cast({drawn_count} as bigint))"


def draw_shares(seed: int, key: str, capacity: str, rows: str) -> str:
    """SQL for an array of bigint: how many of ``rows`` rows drawn without
    replacement fall to each entry of the array ``capacity``."""
    u = f"(pmod(xxhash64({seed}L, {key}, s), 9007199254740992L) / 9007199254740992D)"
    one = _hypergeometric("b.total", f"{capacity}[s]", "b.n", u)
    step = _let("x", one, f"named_struct('total', b.total - {capacity}[s], 'n', b.n - x, 'out', concat(b.out, array(x)))")
    total = f"aggregate({capacity}, 0L, (q, c) -> q + c)"
    start = f"named_struct('total', {total}, 'n', cast({rows} as bigint), 'out', cast(array() as array<bigint>))"
    return f"aggregate(sequence(0, size({capacity}) - 1), {start}, (b, s) -> {step}).out"


def communication_matrix(counts: DataFrame, partitions: int, shards: int, rows: int, seed: int) -> DataFrame:
    """One row (part, share array) per partition; ``counts``: (part, n)."""
    base, extra = divmod(rows, shards)
    capacity = F.array(*[F.lit(base + (s < extra)).cast("bigint") for s in range(shards)])
    node = counts.agg(F.map_from_entries(F.collect_list(F.struct(F.col("part").cast("bigint"), F.col("n").cast("bigint")))).alias("m")).select(
        F.lit(0).cast("bigint").alias("part"),
        F.expr(f"transform(sequence(0L, {partitions - 1}L), p -> coalesce(m[p], 0L))").alias("n"),
        capacity.alias("share"),
    )
    width, level = partitions, 0
    while width > 1:
        halves = node.withColumn("half", F.expr("cast(ceil(size(n) / 2) as int)"))
        left = draw_shares(seed + level + 1, "part", "share", "aggregate(slice(n, 1, half), 0L, (q, c) -> q + c)")
        halves = halves.withColumn("taken", F.expr(f"if(size(n) < 2, share, {left})"))
        children = F.expr(
            "if(size(n) < 2, array(named_struct('part', part, 'n', n, 'share', share)), array("
            "named_struct('part', part, 'n', slice(n, 1, half), 'share', taken), "
            "named_struct('part', part + half, 'n', slice(n, half + 1, size(n) - half), 'share', transform(share, (c, i) -> c - taken[i]))))"
        )
        node = halves.select(F.explode(children).alias("c")).select("c.*")
        width, level = (width + 1) // 2, level + 1
        if level == 6 and width > 1:
            node = node.repartition("part")
    return node.select("part", "share")


def shard(df: DataFrame, shards: int, seed: int = 0, partition_rows: int = PARTITION_ROWS, min_partitions: int = MIN_PARTITIONS) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in
    each shard): a uniform shuffle whose shard sizes differ by one at most."""
    df = df.drop("shard", "slot")
    own = [F.col(f"`{c}`") for c in df.columns]
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    rows = df.count()
    partitions = max(min_partitions, -(-rows // partition_rows))
    dealt = df.select(
        *own,
        F.pmod(F.xxhash64(F.lit(seed), F.lit("part"), *hashed), F.lit(partitions)).alias("_part"),
        F.xxhash64(F.lit(seed), F.lit("local"), *hashed).alias("_local"),
        F.xxhash64(F.lit(seed), F.lit("slot"), *hashed).alias("_order"),
    )
    counts = dealt.groupBy(F.col("_part").alias("part")).agg(F.count("*").alias("n"))
    matrix = written(communication_matrix(counts, partitions, shards, rows, seed), "shard-matrix")
    cuts = matrix.select(F.col("part").alias("_part"), F.expr("aggregate(share, cast(array() as array<bigint>), (a, x) -> concat(a, array(coalesce(get(a, size(a) - 1), 0L) + x)))").alias("_cuts"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_local", "_order")) - 1
    stretches = max(1, -(-rows // (shards * partition_rows)))
    sent = (
        dealt.withColumn("_rank", place)
        .join(cuts, "_part")
        .select(
            *own,
            F.expr("size(filter(_cuts, c -> c <= _rank))").cast("int").alias("shard"),
            "_order",
            F.shiftrightunsigned(F.xxhash64(F.lit("stretch"), F.col("_order")), 33).alias("_u"),
        )
        .withColumn("_stretch", F.floor(F.col("_u") * stretches / (1 << 31)).cast("int"))
        .drop("_u")
    )
    sent = written(sent, "shard-rows")
    sizes = sent.groupBy("shard", "_stretch").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_stretch", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    again = F.row_number().over(Window.partitionBy("shard", "_stretch").orderBy("_order", F.xxhash64(*hashed)))
    return sent.withColumn("_again", again).join(offsets, ["shard", "_stretch"]).select(*own, "shard", (F.col("_before") + F.col("_again") - 1).cast("bigint").alias("slot"))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)
