"""Functions on dotted codes (`01.1.2.3.4`); all are plain column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = (1, 2, 3, 4, 5)
TECHNICAL = ("98", "99")

# The name of each depth of the nomenclature, as used in its page addresses.
LEVEL_NAMES = {1: "division", 2: "groupe", 3: "classe", 4: "sousClasse", 5: "poste"}


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def code_depth(code: Column | str) -> Column:
    """Number of dot-separated segments; NULL for NULL."""
    code = _col(code)
    return F.length(code) - F.length(F.replace(code, F.lit("."), F.lit(""))) + F.lit(1)


def pad_code(code: Column | str) -> Column:
    """`code` with its first segment left-padded with zeros to two characters, never cut."""
    code = _col(code)
    first = F.substring_index(code, ".", 1)
    return F.concat(F.repeat(F.lit("0"), F.greatest(F.lit(2) - F.length(first), F.lit(0))), code)


def code_level(code: Column | str, level: int, padded: bool = False) -> Column:
    """Prefix of `level` segments, NULL when the code is shallower.

    Level 1 is always zero-padded; deeper levels keep the first segment as written unless `padded`.
    """
    code = _col(code)
    source = pad_code(code) if padded or level == 1 else code
    if level == 1:
        return F.substring_index(source, ".", 1)
    return F.when(code_depth(code) >= level, F.substring_index(source, ".", level))


def code_levels(code: Column | str, padded: bool = False, levels: Iterable[int] = LEVELS) -> Column:
    """Struct `level1..levelN` of prefixes."""
    return F.struct(*[code_level(code, n, padded).alias(f"level{n}") for n in levels])


def code_levels_padded(code: Column | str) -> Column:
    """Levels 1 to 4 that all use the zero-padded first segment, as the reports do."""
    return code_levels(code, padded=True, levels=(1, 2, 3, 4))


def parent_code(code: Column | str) -> Column:
    """Code without its last segment, NULL at level 1."""
    code = _col(code)
    return F.when(code_depth(code) > 1, F.regexp_replace(code, r"\.[^.]*$", ""))


def is_level(code: Column | str, level: int) -> Column:
    return code_depth(code) == level


def is_leaf(code: Column | str) -> Column:
    return is_level(code, 5)


def is_technical(code: Column | str) -> Column:
    """Loaders' test: the code starts with 98 or 99 as a string, so `989` counts too."""
    code = _col(code)
    return code.startswith(TECHNICAL[0]) | code.startswith(TECHNICAL[1])


def is_technical_division(code: Column | str) -> Column:
    """Reports' test: the padded first segment equals 98 or 99."""
    return code_level(code, 1).isin(*TECHNICAL)


def code_prefix(code: Column | str, length: int = 8) -> Column:
    """First `length` characters; 8 give the level-4 code when the first segment has two digits."""
    return F.substring(_col(code), 1, length)


def level4_key(code: Column | str) -> Column:
    """First four segments as written; shallower codes unchanged."""
    return F.substring_index(_col(code), ".", 4)


def level_name(code: Column | str) -> Column:
    """Name of the code's depth, NULL when it has none."""
    names = F.create_map(*[F.lit(part) for item in LEVEL_NAMES.items() for part in item])
    return F.try_element_at(names, code_depth(code))


def taxonomy_url(code: Column | str, base: str) -> Column:
    """Page address `base/<level name>/<code>`; NULL for an unknown depth."""
    return F.concat(F.lit(base), F.lit("/"), level_name(code), F.lit("/"), _col(code))


def with_levels(df: DataFrame, code: str = "code", padded: bool = False, prefix: str = "",
                levels: Iterable[int] = LEVELS) -> DataFrame:
    """Add `<prefix>level1..5` columns."""
    return df.withColumns({f"{prefix}level{n}": code_level(code, n, padded) for n in levels})


def taxonomy_with_levels(df: DataFrame) -> DataFrame:
    """Taxonomy rows (`code, libelle`) with their level columns."""
    return with_levels(df)


def level_classes(df: DataFrame, level: int) -> DataFrame:
    """Sorted distinct codes of one level column."""
    name = f"level{level}"
    return df.select(F.col(name).alias("code")).where(F.col("code").isNotNull()).distinct().orderBy("code")


def children_map(df: DataFrame, levels: Iterable[int] = LEVELS) -> DataFrame:
    """Distinct `(level, parent, child)` of the level columns; the parent of a level-2 code is padded."""
    pairs = [
        F.struct(
            F.lit(n).alias("level"),
            (code_level(f"level{n}", 1) if n == 2 else F.substring_index(F.col(f"level{n}"), ".", n - 1)).alias("parent"),
            F.col(f"level{n}").alias("child"),
        )
        for n in levels if n > 1
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("child").isNotNull())
        .distinct()
    )


def ancestor_path(taxonomy: DataFrame, separator: str = " > ") -> DataFrame:
    """Add `path`: labels of each code's proper ancestors, root first; missing ancestors are skipped.

    A code has at most a handful of ancestors, so the collected list stays tiny whatever the table's size.
    """
    steps = taxonomy.select(
        "code", F.explode(F.sequence(F.lit(1), F.greatest(code_depth("code") - 1, F.lit(1)))).alias("depth")
    ).select("code", "depth", F.call_function("substring_index", F.col("code"), F.lit("."), F.col("depth")).alias("ancestor"))
    labels = taxonomy.where(F.col("libelle") != "").select(F.col("code").alias("ancestor"), "libelle")
    paths = (
        steps.where(F.col("ancestor") != F.col("code"))
        .join(labels, "ancestor")
        .groupBy("code")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "libelle"))).alias("steps"))
        .select("code", F.array_join("steps.libelle", separator).alias("path"))
    )
    return taxonomy.join(paths, "code", "left").withColumn("path", F.coalesce("path", F.lit("")))
