"""Decoding level by level on a table of scores `(id, level, parent_code, code, confidence)`.

The candidates of one id are bounded by the nomenclature, so each decoder gathers them per id with one shuffle and
walks the levels inside the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ramure.functions.codes import LEVELS

PATH_TYPE = "array<struct<level:int,code:string,confidence:double>>"
BEAM_TYPE = "array<struct<order:double,path:array<string>,levels:array<int>,confs:array<double>,lp:double>>"
MASK_TYPE = "struct<cur:string,rows:array<struct<level:int,code:string,p:double>>>"


def bucket_confidence(confidence: Column, buckets: int = 10) -> Column:
    """Index of the confidence among equal buckets, cut towards zero and clipped to the range."""
    return F.least(F.greatest(F.floor(confidence * buckets).cast("int"), F.lit(0)), F.lit(buckets - 1))


def seeded_fraction(seed: int, *columns: Column) -> Column:
    """A reproducible number in [0, 1) with four digits from a hash of seed and columns."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[column.cast("string") for column in columns]))
    return F.pmod(F.conv(F.substring(digest, 1, 7), 16, 10).cast("long"), F.lit(10_000)) / 10_000.0


def teacher_force(df: DataFrame, level: int, ratio: float, seed: int = 42, key: str = "id", true_parent: str = "parent",
                  predicted_parent: str = "predicted_parent", confidence: str = "confidence") -> DataFrame:
    """Add `parent_used` and `bucket` for training a level.

    With probability `1 - ratio` the previous level's prediction takes the place of the true parent; rows without a
    prediction keep the truth. The bucket is that of the previous confidence, 0.9 when there is none.
    """
    drawn = seeded_fraction(seed, F.lit(level), F.col(key)) < (1 - ratio)
    parent = F.when(drawn & F.col(predicted_parent).isNotNull(), F.col(predicted_parent)).otherwise(F.col(true_parent))
    return df.withColumns({
        "parent_used": parent, "bucket": bucket_confidence(F.coalesce(F.col(confidence), F.lit(0.9)))})


def _node(level: Column, parent: Column) -> Column:
    return F.concat(level.cast("string"), F.lit("|"), parent)


def _last(values: Column) -> Column:
    return F.coalesce(F.get(values, F.size(values) - 1), F.lit(""))


def _children(scores: DataFrame, width: int) -> DataFrame:
    """Per id, map from `level|parent` to the `width` best children, best first, equal ones by code."""
    keyed = scores.select("id", _node(F.col("level"), F.coalesce("parent_code", F.lit(""))).alias("node"),
                          F.struct((-F.col("confidence")).alias("neg"), F.col("code").alias("code")).alias("child"))
    grouped = keyed.groupBy("id", "node")
    if width == 1:
        best = grouped.agg(F.array(F.min("child")).alias("children"))
    else:
        # as many entries as a code has children
        best = grouped.agg(F.slice(F.sort_array(F.collect_list("child")), 1, width).alias("children"))
    return best.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("node", "children"))).alias("tree"))


def cascade_decode(scores: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """`id, path`: at each level the best child of the code chosen before; levels without candidates are skipped."""
    def step(path: Column, level: Column) -> Column:
        chosen = F.get(F.try_element_at("tree", _node(level, _last(path["code"]))), F.lit(0))
        return F.when(
            chosen.isNotNull(),
            F.concat(path, F.array(F.struct(level.alias("level"), chosen["code"].alias("code"),
                                            (-chosen["neg"]).alias("confidence")))).cast(PATH_TYPE),
        ).otherwise(path)

    path = F.aggregate(F.array(*[F.lit(n) for n in levels]), F.array().cast(PATH_TYPE), step)
    return _children(scores, 1).select("id", path.alias("path"))


def combine_confidence(df: DataFrame, threshold: float | None = None, path: str = "path") -> DataFrame:
    """Add `final_code, final_level, final_confidence, combined_confidence` from an ordered array of levels.

    Levels count up to the first one below the threshold, which is left out with all below it; the combined confidence
    is the product of those that count. With none the code is '' and the product 1.
    """
    accepted = F.col(path)
    if threshold is not None:
        bad = F.array_position(F.transform(accepted, lambda item: item["confidence"] < threshold), F.lit(True))
        accepted = F.when(bad > 0, F.slice(accepted, F.lit(1), F.greatest(bad.cast("int") - 1, F.lit(0)))).otherwise(accepted)
    kept = df.withColumn("__accepted", accepted)
    last = F.get(F.col("__accepted"), F.size("__accepted") - 1)
    product = F.aggregate("__accepted", F.lit(1.0), lambda acc, item: acc * item["confidence"])
    return kept.withColumns({
        "final_code": F.coalesce(last["code"], F.lit("")),
        "final_level": F.coalesce(F.concat(F.lit("level"), last["level"].cast("string")), F.lit("")),
        "final_confidence": F.coalesce(last["confidence"], F.lit(0.0)),
        "combined_confidence": product,
    }).drop("__accepted")


def beam_decode(scores: DataFrame, beam_size: int, levels: Sequence[int] = LEVELS) -> DataFrame:
    """`id, beams`: the `beam_size` best paths by joint log confidence, best first.

    Each beam is extended by the best children of its own last code; a beam without children stays as it is. Equal
    beams are ordered by their codes.
    """
    def extend(beam: Column, level: Column) -> Column:
        children = F.try_element_at("tree", _node(level, _last(beam["path"])))

        def grown(child: Column) -> Column:
            lp = beam["lp"] + F.log(F.greatest(-child["neg"], F.lit(1e-9)))
            # the order is compared to nine digits, so that equal products in another order stay equal
            return F.struct(F.round(-lp, 9).alias("order"), F.array_append(beam["path"], child["code"]).alias("path"),
                            F.array_append(beam["levels"], level).alias("levels"),
                            F.array_append(beam["confs"], -child["neg"]).alias("confs"), lp.alias("lp"))

        return F.when(children.isNull(), F.array(beam).cast(BEAM_TYPE)).otherwise(
            F.transform(children, grown).cast(BEAM_TYPE))

    def step(beams: Column, level: Column) -> Column:
        grown = F.flatten(F.transform(beams, lambda beam: extend(beam, level)))
        return F.slice(F.sort_array(grown), 1, beam_size).cast(BEAM_TYPE)

    empty = F.array(F.struct(F.lit(0.0).alias("order"), F.array().alias("path"), F.array().alias("levels"),
                             F.array().alias("confs"), F.lit(0.0).alias("lp"))).cast(BEAM_TYPE)
    beams = F.aggregate(F.array(*[F.lit(n) for n in levels]), empty, step)
    return _children(scores, beam_size).select("id", beams.alias("beams"))


def beam_result(df: DataFrame) -> DataFrame:
    """`final_code, final_level, final_confidence, combined_confidence` of the best beam."""
    best = F.col("beams")[0]
    level = F.get(best["levels"], F.size(best["levels"]) - 1)
    return df.select(
        "id", _last(best["path"]).alias("final_code"),
        F.coalesce(F.concat(F.lit("level"), level.cast("string")), F.lit("")).alias("final_level"),
        F.coalesce(F.get(best["confs"], F.size(best["confs"]) - 1), F.lit(0.0)).alias("final_confidence"),
        F.exp(best["lp"]).alias("combined_confidence"))


def beam_long(df: DataFrame) -> DataFrame:
    """`(id, level, rank, code, confidence)`: the code of each beam at each level; codes can repeat."""
    ranked = df.select("id", F.posexplode("beams").alias("pos", "beam"))
    steps = F.arrays_zip(F.col("beam.levels").alias("level"), F.col("beam.path").alias("code"),
                         F.col("beam.confs").alias("confidence"))
    return ranked.select("id", (F.col("pos") + 1).alias("rank"), F.inline(steps)).select(
        "id", "level", "rank", "code", "confidence")


def mask_children(probs: DataFrame, children: DataFrame, levels: Sequence[int] = LEVELS) -> DataFrame:
    """`(id, level, code, p)` with impossible codes at 0.

    From the second level on only children of the best code above keep their probability, made to sum to 1; when all of
    them are 0 they share it equally, and a code without known children leaves the level as it is. Of equal best codes
    the highest is taken. A code listed under several parents is a child of each.
    """
    parents = children.groupBy("level", F.col("child").alias("code")).agg(F.collect_set("parent").alias("parents"))
    # as many rows as the nomenclature has codes; candidates stay where they are
    joined = probs.join(F.broadcast(parents), ["level", "code"], "left")
    gathered = joined.groupBy("id").agg(F.collect_list(F.struct("level", "code", "p", "parents")).alias("all"))

    def step(state: Column, level: Column) -> Column:
        here = F.filter("all", lambda row: row["level"] == level)
        valid = F.filter(here, lambda row: F.array_contains(row["parents"], state["cur"]))
        total = F.aggregate(valid, F.lit(0.0), lambda acc, row: acc + row["p"])
        share = F.lit(1.0) / F.size(valid)

        def masked(row: Column) -> Column:
            p = (
                F.when(F.size(valid) == 0, row["p"])
                .when(~F.coalesce(F.array_contains(row["parents"], state["cur"]), F.lit(False)), F.lit(0.0))
                .when(total > 0, row["p"] / total).otherwise(share)
            )
            return F.struct(row["level"].alias("level"), row["code"].alias("code"), p.alias("p"))

        rows = F.transform(here, masked)
        best = F.array_max(F.transform(rows, lambda row: F.struct(row["p"].alias("p"), row["code"].alias("code"))))
        return F.struct(F.coalesce(best["code"], state["cur"]).alias("cur"),
                        F.concat(state["rows"], rows).alias("rows")).cast(MASK_TYPE)

    start = F.struct(F.lit("").alias("cur"), F.array().alias("rows")).cast(MASK_TYPE)
    walked = F.aggregate(F.array(*[F.lit(n) for n in sorted(levels)]), start, step)
    return gathered.select("id", F.inline(walked["rows"]))


def to_wide(long: DataFrame, levels: Sequence[int] = LEVELS, top_k: int = 1, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Long predictions to columns `predicted_level{N}[_top{R}], confidence_level{N}[_top{R}]`.

    An absent prediction gives '' and 0.0.
    """
    columns = []
    for n in levels:
        for rank in range(1, top_k + 1):
            suffix = "" if rank == 1 else f"_top{rank}"
            here = (F.col("level") == n) & (F.col("rank") == rank)
            columns += [
                F.coalesce(F.max(F.when(here, F.col("code"))), F.lit("")).alias(f"predicted_level{n}{suffix}"),
                F.coalesce(F.max(F.when(here, F.col("confidence"))), F.lit(0.0)).alias(f"confidence_level{n}{suffix}"),
            ]
    return long.groupBy(*keys).agg(*columns)


def to_wide_flat(long: DataFrame, top_k: int = 1, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Flat predictions `(id, rank, code, confidence)` to `predicted_code[_top{R}], confidence[_top{R}]`."""
    columns = []
    for rank in range(1, top_k + 1):
        suffix = "" if rank == 1 else f"_top{rank}"
        here = F.col("rank") == rank
        columns += [
            F.coalesce(F.max(F.when(here, F.col("code"))), F.lit("")).alias(f"predicted_code{suffix}"),
            F.coalesce(F.max(F.when(here, F.col("confidence"))), F.lit(0.0)).alias(f"confidence{suffix}"),
        ]
    return long.groupBy(*keys).agg(*columns)


def path_long(df: DataFrame, path: str = "path") -> DataFrame:
    """Decoded paths as `(id, level, rank, code, confidence)`, rank 1."""
    return df.select("id", F.inline(path)).select("id", "level", F.lit(1).alias("rank"), "code", "confidence")
