"""Mixing sources to target weights by Pfair scheduling: earliest deadline first among the blocks that are released."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_name, needs, stored

REST = "<rest>"
#: Weights, in slots of each period, that the registered query and the pipeline mix to.
QUERY_WEIGHTS = {f"src{k}": 1 + k % 5 for k in range(20)}
_MOST_PLAN = 1_000_000
_CELLS = 4096  # ranges of positions that whole rows are dealt to


def _pattern(shares: Column, total: Column) -> Column:
    """The class (position in ``shares``) that each slot of a period gets.

    Block j (from 0) of a class with share a of W slots is released at floor(j W / a) and due at ceil((j + 1) W / a);
    each slot goes to the released block with the earliest deadline, the first class on ties. As the shares add up
    to W, every block runs inside its window, so no class is ever a whole block ahead of or behind its weight.
    """

    def step(state: Column, t: Column) -> Column:
        due = F.transform(
            F.arrays_zip(state["done"].alias("done"), shares.alias("share")),
            lambda x: F.when(
                F.floor(x["done"] * total / x["share"]) <= t, F.ceil((x["done"] + 1) * total / x["share"])
            ).otherwise(F.lit(2) * total + 2),
        )
        at = (F.array_position(due, F.array_min(due)) - 1).cast("int")
        done = F.transform(state["done"], lambda x, i: x + F.when(i == at, 1).otherwise(0))
        return F.struct(done.alias("done"), F.concat(state["out"], F.array(at)).alias("out"))

    start = F.struct(
        F.transform(shares, lambda _: F.lit(0)).alias("done"), F.array().cast("array<int>").alias("out")
    )
    return F.aggregate(F.sequence(F.lit(0), (total - 1).cast("int")), start, step, lambda s: s["out"])


def _plan(counts: DataFrame, block_rows: int) -> DataFrame:
    """One row for each class(cls, share, rows): its phases' ends, starts, first slots, lengths and slots in a period.

    All classes start together. A period gives each active class its share of blocks; a class is active up to its
    last period, and a phase is a run of periods with the same active classes, planned anew.
    """
    classes = counts.withColumn("ends", F.ceil(F.ceil(F.col("rows") / block_rows) / F.col("share")))
    one = classes.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("cls", "share", "ends"))).alias("all"), F.sort_array(F.collect_set("ends")).alias("list")
    )
    spans = F.transform("list", lambda end, k: F.struct(F.coalesce(F.get("list", k - 1), F.lit(0)).alias("begin"), end.alias("end")))
    active = one.select("all", F.posexplode(spans).alias("phase", "span")).select(
        "phase", "span.begin", "span.end",
        F.transform(
            F.filter("all", lambda c: c["ends"] > F.col("span.begin")), lambda c: F.struct(c["cls"].alias("cls"), c["share"].alias("share"))
        ).alias("who"),
    )
    length = F.aggregate("who.share", F.lit(0), lambda x, y: x + y)
    planned = active.withColumn("length", length).withColumn("slots", _pattern(F.col("who.share"), F.col("length")))
    everything = planned.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("phase", "begin", "end", "length", "who", "slots"))).alias("phases")
    )
    first = F.transform(
        F.sequence(F.lit(0), F.size("phases") - 1),
        lambda k: F.aggregate(
            F.slice("phases", F.lit(1), k), F.lit(0).cast("long"), lambda x, p: x + (p["end"] - p["begin"]) * p["length"]
        ),
    )
    each = everything.withColumn("first", first).select("phases", "first", F.explode(F.flatten("phases.who")).alias("one"))
    own = F.transform(
        "phases",
        lambda p: F.filter(
            F.transform(p["slots"], lambda at, t: F.when(F.get(p["who"], at)["cls"] == F.col("one.cls"), t)),
            lambda t: t.isNotNull(),
        ),
    )
    return each.dropDuplicates(["one"]).select(
        F.col("one.cls").alias("cls"),
        F.col("one.share").alias("share"),
        F.col("phases.begin").alias("begins"),
        F.col("phases.end").alias("ends"),
        F.col("phases.length").alias("lengths"),
        "first",
        own.alias("own"),
    )


def _keyed(docs: DataFrame, weights: dict[str, int], rest_weight: int, id_col: str, source_col: str) -> tuple[DataFrame, dict[str, str]]:
    """docs with class, share, hash and the hash's first digits; and the names, free in docs, of all working columns."""
    needs(docs, id_col, source_col)
    if not all(isinstance(w, int) and w >= 1 for w in [*weights.values(), rest_weight]):
        raise ValueError("weights are whole numbers of at least 1")
    if (len(weights) + 1) * (sum(weights.values()) + rest_weight) > _MOST_PLAN:
        raise ValueError(f"the weights make a plan of over {_MOST_PLAN} slots; use smaller numbers")
    keys = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.lit(None).cast("map<string,int>")
    share = F.coalesce(F.try_element_at(keys, F.coalesce(F.col(source_col).cast("string"), F.lit(""))), F.lit(0))
    wanted = ("_cls", "_share", "_hash", "_part", "_rank", "_block", "_plan", "_of_cls", "_of_part", "_offset", "_key", "_cell", "_bounds")
    names = {c: fresh_name(docs.columns, c) for c in wanted}
    cls, sh, h, part = (names[c] for c in wanted[:4])
    content = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]  # what a hash can take
    rows = (
        docs.withColumn(sh, share)
        .withColumn(cls, F.when(F.col(sh) > 0, F.col(source_col).cast("string")).otherwise(F.lit(REST)))
        .withColumn(sh, F.when(F.col(sh) > 0, F.col(sh)).otherwise(F.lit(rest_weight)))
        .withColumn(h, F.md5(F.coalesce(F.col(id_col).cast("string"), F.xxhash64(*content).cast("string"))))
        .withColumn(part, F.substring(h, 1, 3))
    )
    return rows, names


def _sizes(rows: DataFrame, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The rows of each class and part of the hashes, and of each class."""
    cls, sh = names["_cls"], names["_share"]
    sizes = rows.groupBy(cls, sh, names["_part"]).agg(F.count(F.lit(1)).alias("n"))
    return sizes, sizes.groupBy(F.col(cls).alias("cls"), F.col(sh).alias("share")).agg(F.sum("n").alias("rows"))


def _by_rank(ranked: DataFrame, plans: DataFrame, block_rows: int, names: dict[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """ranked with what its columns of mix_position, mix_slot, mix_release and mix_deadline need; and these."""
    cls, sh, rank, block, plan, of_cls = (names[c] for c in ("_cls", "_share", "_rank", "_block", "_plan", "_of_cls"))
    plans = plans.select(F.col("cls").alias(of_cls), F.struct("begins", "ends", "lengths", "first", "own").alias(plan))
    placed = ranked.withColumn(block, F.floor(F.col(rank) / block_rows)).join(F.broadcast(plans), F.col(cls) == F.col(of_cls))
    period = F.floor(F.col(block) / F.col(sh))
    index = (F.col(block) % F.col(sh)).cast("int")
    phase = F.size(F.filter(F.col(f"{plan}.ends"), lambda e: e <= period))
    length = F.get(F.col(f"{plan}.lengths"), phase)
    base = F.get(F.col(f"{plan}.first"), phase) + (period - F.get(F.col(f"{plan}.begins"), phase)) * length
    slot = base + F.get(F.get(F.col(f"{plan}.own"), phase), index)
    return placed, {
        "mix_position": slot * block_rows + F.col(rank) % block_rows,
        "mix_slot": slot,
        "mix_release": base + F.floor(index * length / F.col(sh)),
        "mix_deadline": base + F.ceil((index + 1) * length / F.col(sh)),
    }


def mix_sources(
    docs: DataFrame, weights: dict[str, int], rest_weight: int = 1, block_rows: int = 16, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """docs with mix_position, mix_slot, mix_release and mix_deadline: their place in an order mixed to ``weights``.

    Each source's rows, ordered by a hash of the id, are cut into blocks of ``block_rows``; a slot of the order holds
    one block. Every row is placed, none repeated: when a source ends, the others go on at their weights. Until a
    source's last period each source is always less than one block from its share of the slots of the phase.

    Weights are whole numbers of at least 1, so a period has as many slots as they add up to. Sources without a
    weight, and null ones, form one class together with ``rest_weight``. The plan, of at most classes times period
    slots, is the only thing broadcast: its size follows the parameter ``weights``, not the data.

    Nulls: rows with a null id are hashed by their content, so many of them aren't one group. More slots in a plan than
    ``_MOST_PLAN`` are an error, no row is left out. Ties and repeated rows: equal rows take neighbouring
    places in any order. Other columns pass through; a clashing new column gets a leading underscore.
    """
    rows, names = _keyed(docs, weights, rest_weight, id_col, source_col)
    h, part, cls, rank, offset, of_cls, of_part = (names[c] for c in ("_hash", "_part", "_cls", "_rank", "_offset", "_of_cls", "_of_part"))
    sizes, totals = _sizes(rows, names)
    before = Window.partitionBy(cls).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(cls).alias(of_cls), F.col(part).alias(of_part), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset)
    )
    ranked = (
        rows.withColumn(rank, F.row_number().over(Window.partitionBy(cls, part).orderBy(h, id_col)) - 1)
        .join(offsets, (F.col(cls) == F.col(of_cls)) & (F.col(part) == F.col(of_part)))
        .withColumn(rank, F.col(rank) + F.col(offset))
        .drop(of_cls, of_part, offset)
    )
    placed, new = _by_rank(ranked, _plan(totals, block_rows), block_rows, names)
    return placed.select(*docs.columns, *[v.cast("long").alias(fresh_name(docs.columns, c)) for c, v in new.items()])


def in_mixed_order(
    docs: DataFrame, weights: dict[str, int], rest_weight: int = 1, block_rows: int = 16, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """docs in the order of ``mix_sources``'s mix_position; whole rows are shuffled once.

    Positions come first, of sources and hashes alone. In each class they grow with the hash, so a range of positions, a
    cell, is one range of hashes of each class. A row finds its cell by its hash in at most ``_CELLS`` bounds of its class,
    goes there, and is ranked there anew. Rows of equal hash share a cell: cells that such rows lie across are one.

    ``docs`` is read twice and must give the same rows both times. Nulls, ties and repeated rows are as in ``mix_sources``.
    """
    rows, names = _keyed(docs, weights, rest_weight, id_col, source_col)
    h, cls, sh, block, rank, of_cls, plan, key, cell, bounds = (
        names[c] for c in ("_hash", "_cls", "_share", "_block", "_rank", "_of_cls", "_plan", "_key", "_cell", "_bounds")
    )
    rows = rows.withColumn(key, F.conv(F.substring(h, 1, 15), 16, 10).cast("long"))
    narrow = stored(rows.select(cls, sh, h, key, names["_part"]), "hashes")
    if narrow.isEmpty():
        return docs
    sizes, totals = _sizes(narrow, names)
    plans = stored(_plan(totals, block_rows), "plans")
    before = Window.partitionBy(cls).orderBy(names["_part"]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(cls, names["_part"], F.coalesce(F.sum("n").over(before), F.lit(0)).alias(names["_offset"]))
    ranked = narrow.withColumn(rank, F.row_number().over(Window.partitionBy(cls, names["_part"]).orderBy(h)) - 1)
    ranked = ranked.join(offsets, [cls, names["_part"]]).withColumn(rank, F.col(rank) + F.col(names["_offset"]))
    placed, new = _by_rank(ranked, plans, block_rows, names)
    places = stored(placed.select(cls, key, rank, new["mix_position"].cast("long").alias("at")), "places")
    width = max(block_rows, -(-((places.agg(F.max("at")).first()[0] or 0) + 1) // _CELLS))
    groups = places.groupBy(cls, key).agg(F.min(rank).alias("first"), F.floor(F.min("at") / width).alias("low"), F.floor(F.max("at") / width).alias("high"))
    groups = stored(groups, "cells")
    across = groups.filter("low < high").select(F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("c")).distinct()
    joined = {r["c"] for r in across.collect()}  # at most _CELLS numbers
    starts = F.array(*[F.lit(c) for c in range(_CELLS) if c not in joined]) if joined else None
    number = F.col("low") if starts is None else F.element_at(F.filter(starts, lambda c: c <= F.col("low")), -1)
    cells = groups.groupBy(cls, number.cast("long").alias("cell")).agg(F.min(key).alias("key"), F.min("first").alias("first"))
    listed = cells.groupBy(F.col(cls).alias(of_cls)).agg(F.sort_array(F.collect_list(F.struct("key", "cell", "first"))).alias("all"))
    listed = stored(listed.select(of_cls, F.struct(*[F.col(f"all.{c}").alias(c) for c in ("key", "cell", "first")]).alias(bounds)), "bounds")
    found = F.aggregate(  # the last bound that isn't over the key
        F.array(*[F.lit(1 << k) for k in reversed(range(_CELLS.bit_length()))]), F.lit(0),
        lambda low, step: F.when(F.get(F.col(f"{bounds}.key"), low + step) <= F.col(key), low + step).otherwise(low),
    )
    dealt = rows.join(F.broadcast(listed), F.col(cls) == F.col(of_cls)).withColumn(block, found)
    dealt = dealt.withColumn(cell, F.get(F.col(f"{bounds}.cell"), F.col(block))).withColumn(rank, F.get(F.col(f"{bounds}.first"), F.col(block)))
    dealt = dealt.select(*docs.columns, cls, sh, h, cell, rank).repartitionByRange(cell)
    inside = F.row_number().over(Window.partitionBy(cell, cls).orderBy(h, id_col)) - 1
    placed, new = _by_rank(dealt.withColumn(rank, F.col(rank) + inside), plans, block_rows, names)
    at = names["_offset"]
    return placed.withColumn(at, new["mix_position"]).select(*docs.columns, at).sortWithinPartitions(at).drop(at)


def op9_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mix_sources(docs, QUERY_WEIGHTS)


def op9_sql(weights: dict[str, int] = QUERY_WEIGHTS, rest_weight: int = 1, block_rows: int = 16) -> str:
    values = ", ".join(f"('{s}', {a})" for s, a in weights.items())
    return f"""
WITH RECURSIVE w(name, share) AS (VALUES {values}),
d AS (
  SELECT doc_id, source, coalesce(w.name, '{REST}') AS cls, coalesce(w.share, {rest_weight}) AS share
  FROM documents LEFT JOIN w ON source = w.name
), r AS (
  SELECT *, row_number() OVER (PARTITION BY cls ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rk FROM d
), c AS (
  SELECT cls, share, count(*) AS n FROM d GROUP BY ALL
), c2 AS (
  SELECT cls, share, CAST(ceil(ceil(n / {block_rows}) / share) AS BIGINT) AS ends FROM c
), ph AS (
  SELECT ends AS p, lag(ends, 1, 0) OVER (ORDER BY ends) AS b, row_number() OVER (ORDER BY ends) AS k FROM (SELECT DISTINCT ends FROM c2)
), act AS (
  SELECT k, b, p, list(cls ORDER BY cls) AS who, list(share ORDER BY cls) AS shares, CAST(sum(share) AS BIGINT) AS len
  FROM ph JOIN c2 ON ends > b GROUP BY ALL
), st AS (
  SELECT *, CAST(coalesce(sum((p - b) * len) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first FROM act
), sim(k, t, done, pick) AS (
  SELECT k, CAST(-1 AS BIGINT), list_transform(shares, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM st
  UNION ALL
  SELECT k, t, list_transform(done, lambda x, i: CASE WHEN i = pick THEN x + 1 ELSE x END), pick FROM (
    SELECT k, t, done, CAST(list_position(due, list_min(due)) AS BIGINT) AS pick FROM (
      SELECT sim.k, sim.t + 1 AS t, done, list_transform(done, lambda x, i:
        CASE WHEN (x * len) // shares[i] <= sim.t + 1 THEN ((x + 1) * len + shares[i] - 1) // shares[i] ELSE 2 * len + 2 END) AS due
      FROM sim JOIN st ON sim.k = st.k WHERE sim.t + 1 < st.len))
), pat AS (
  SELECT sim.k, who[pick] AS cls, t, row_number() OVER (PARTITION BY sim.k, who[pick] ORDER BY t) - 1 AS i
  FROM sim JOIN st ON sim.k = st.k WHERE t >= 0
), x AS (
  SELECT r.*, rk // {block_rows} AS block FROM r
), y AS (
  SELECT x.*, st.k, first + (block // share - b) * len AS base, block % share AS i, len
  FROM x JOIN st ON block // share >= b AND block // share < p
)
SELECT doc_id, source, (base + t) * {block_rows} + rk % {block_rows} AS mix_position, base + t AS mix_slot,
       base + (y.i * len) // share AS mix_release, base + ((y.i + 1) * len + share - 1) // share AS mix_deadline
FROM y JOIN pat ON y.k = pat.k AND y.cls = pat.cls AND y.i = pat.i
"""
