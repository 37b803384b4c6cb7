"""Table work around an external text service: request texts, batches, parsed answers, what is left to do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ramure.functions.codes import ancestor_path, is_level, is_technical
from ramure.session import written

# Phrases of introductory lines in an answer, and the bullets in front of items.
INTRODUCTIONS = ("voici", "voilà", "exemples", "catégorie", "coicop", "produits pour", "produits de", "ci-dessous", "suivants")
BULLETS = r"^(- |• |\* |– )"
MAX_LINE = 80
# Openings of the optional sections of a request.
INCLUDE_OPENING = "Cette catégorie comprend: "
EXCLUDE_OPENING = "Cette catégorie NE comprend PAS: "


def taxonomy_lines(taxonomy: DataFrame) -> DataFrame:
    """`code, line`: level-4 codes as `code - label  [ancestor > path]`, technical codes left out."""
    regular = taxonomy.where(~is_technical("code")).select("code", "libelle")
    line = F.concat(F.col("code"), F.lit(" - "), F.col("libelle"))
    full = F.when(F.col("path") != "", F.concat(line, F.lit("  ["), F.col("path"), F.lit("]"))).otherwise(line)
    return ancestor_path(regular).where(is_level("code", 4)).select("code", full.alias("line"))


def generation_requests(taxonomy: DataFrame, level: int = 5, n: int = 10, max_categories: int | None = None,
                        exclude_technical: bool = True) -> DataFrame:
    """One request per code of a level: `code, libelle, n, comprend_section, ne_comprend_section, prompt`."""
    rows = taxonomy.where(is_level("code", level))
    if exclude_technical:
        rows = rows.where(~is_technical("code"))
    if max_categories is not None:
        rows = rows.orderBy("code").limit(max_categories)

    def section(opening: str, column: str) -> Column:
        if column not in taxonomy.columns:
            return F.lit("")
        return F.when(F.coalesce(F.col(column), F.lit("")) != "", F.concat(F.lit(opening), F.col(column))).otherwise(F.lit(""))

    asked = rows.select("code", "libelle", F.lit(n).alias("n"), section(INCLUDE_OPENING, "comprend").alias("comprend_section"),
                        section(EXCLUDE_OPENING, "ne_comprend_pas").alias("ne_comprend_section"))
    parts = [F.format_string("Donne %d noms de produits, un par ligne, pour %s (%s).", F.col("n"), F.col("libelle"), F.col("code"))]
    parts += [F.nullif(F.col(name), F.lit("")) for name in ("comprend_section", "ne_comprend_section")]
    return asked.withColumn("prompt", F.concat_ws("\n", *parts))


def request_records(df: DataFrame, text: str, context: Mapping[str, str] | None = None) -> DataFrame:
    """Add `record`: the text, or with context JSON of the text as `produit` and each labelled value present."""
    missing = [name for name in [text, *(context or {}).values()] if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    if not context:
        return df.withColumn("record", F.col(text).cast("string"))
    fields = [F.col(text).cast("string").alias("produit")]
    fields += [F.col(column).cast("string").alias(label) for label, column in context.items()]
    return df.withColumn("record", F.to_json(F.struct(*fields)))


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "rn") -> DataFrame:
    """Number all rows from 0 in the order of some columns (null first), without any task ordering the whole table.

    Ranges of the order are sorted by themselves and written, so their places stay; a row's number is its place in its range and the
    rows of all ranges before, a sum over one row a range. Rows equal in `order` keep one of their orders.
    """
    place = f"__{name}"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id())
    placed = written(ranged, "ordered").withColumns({f"{place}_range": F.shiftright(place, 33), f"{place}_in": F.col(place).bitwiseAND((1 << 33) - 1)})
    upto = W.orderBy(f"{place}_range").rowsBetween(W.unboundedPreceding, -1)
    before = placed.groupBy(f"{place}_range").agg(F.count("*").alias("n")).select(
        F.col(f"{place}_range"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias(f"{place}_before"))
    return placed.join(before, f"{place}_range").select(*df.columns, (F.col(f"{place}_before") + F.col(f"{place}_in")).alias(name))


def assemble_batches(df: DataFrame, record: str, key: str, size: int = 20) -> DataFrame:
    """`batch, n, payload`: JSON arrays of `size` records in key order; only the last batch may have fewer."""
    numbered = row_numbers(df.select(F.col(key).alias("key"), F.col(record).alias("record")), ["key", "record"])
    items = F.sort_array(F.collect_list(F.struct("rn", "record")))["record"]  # `size` entries at most
    return numbered.groupBy(F.floor(F.col("rn") / size).alias("batch")).agg(F.count("*").alias("n"), F.to_json(items).alias("payload"))


def unfenced(response: Column) -> Column:
    """The answer without the code fence around it."""
    text = F.regexp_replace(response, r"^\s+|\s+$", "")
    inner = F.regexp_replace(F.get(F.split(text, "```"), F.lit(1)), r"^json", "")
    return F.regexp_replace(F.when(text.startswith("```"), inner).otherwise(text), r"^\s+|\s+$", "")


def parse_code_response(df: DataFrame, response: str, size: str | int, valid: DataFrame) -> DataFrame:
    """One row per expected position: `position, code, is_valid`, next to the other columns.

    The answer is a JSON array, maybe fenced. Missing codes are NULL, extra ones ignored, and anything but an array
    gives NULLs. `valid` holds the known codes in `code`.
    """
    count = F.col(size) if isinstance(size, str) else F.lit(size)
    positions = F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(0))), lambda i: i < count)
    others = [name for name in df.columns if name != response]
    # wrapped, so that anything before or after the array makes the whole answer unreadable
    whole = F.concat(F.lit('{"v":'), unfenced(F.col(response)), F.lit("}"))
    rows = df.withColumn("__codes", F.from_json(whole, "v array<string>")["v"]).select(
        *others, F.col("__codes"), F.explode(positions).alias("position"))
    coded = rows.select(*others, "position", F.get("__codes", F.col("position")).alias("code"))
    known = valid.select("code", F.lit(True).alias("__known")).distinct()
    return coded.join(known, "code", "left").select(
        *others, "position", "code", F.coalesce("__known", F.lit(False)).alias("is_valid"))


def attach_labels(df: DataFrame, taxonomy: DataFrame, code: str = "code", label: str = "coicop_libelle") -> DataFrame:
    """Add the label of the code, '' when unknown or NULL; of a code listed with several labels the smallest."""
    labels = taxonomy.groupBy(F.col("code").alias(code)).agg(F.min("libelle").alias(label))
    return df.join(labels, code, "left").select(
        *df.columns, F.coalesce(label, F.lit("")).alias(label))


def pending_rows(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't in the output yet."""
    return rows.join(done.select(key), key, "left_anti")


def parse_product_lines(df: DataFrame, response: str, limit: int) -> DataFrame:
    """The first `limit` product names of each answer: `position, product` next to the other columns.

    Introductions and lines over 80 characters are skipped; bullets and numbering are removed.
    """
    def item(line: Column) -> Column:
        bare = F.regexp_replace(line, BULLETS, "")
        one = bare.rlike(r"^[0-9][.):]") & (F.length(bare) > 2)
        two = bare.rlike(r"^[0-9]{2}[.):]") & (F.length(bare) > 3)
        return F.when(one, _strip(F.substr(bare, F.lit(3)))).when(two, _strip(F.substr(bare, F.lit(4)))).otherwise(bare)

    def wanted(line: Column) -> Column:
        lower = F.lower(line)
        ok = (line != "") & (F.length(line) <= MAX_LINE)
        for phrase in INTRODUCTIONS:
            ok = ok & ~F.contains(lower, F.lit(phrase))
        return ok

    lines = F.filter(F.transform(F.split(F.col(response), "\n"), _strip), wanted)
    products = F.filter(F.transform(lines, item), lambda product: product != "")
    others = [name for name in df.columns if name != response]
    return df.select(*others, F.posexplode(F.slice(products, 1, limit)).alias("position", "product"))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
