"""Sections of the nomenclature's web pages, found inside each row: no window and no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ramure.functions.text import let, squeeze_ws

# Elements without content, and phrases and words that steer the reading of a page.
DROPPED_ELEMENTS = ("script", "style", "nav", "header", "footer")
# Elements that hold a page's content, the first that is there; a class where the element alone doesn't tell.
CONTENT_ELEMENTS = (("div", "contenu-onglet"), ("div", "contenu-central"), ("main", ""), ("article", ""), ("body", ""))
# Phrases and patterns of lines of exclusion and inclusion.
EXCLUSION_PHRASES = ("ne comprend pas", "ne couvre pas")
INCLUSION_WORD = "comprend"
INCLUSION_PATTERN = r"(ce |cette |comprend\s*:)"
NAVIGATION_WORDS = (
    "accueil", "nomenclature", "ecoicop", "télécharger", "navigation", "rechercher", "aller au contenu", "métadonnées",
    "arborescence", "fil d'ariane", "classification européenne", "date de publication", "dernière mise à jour",
    "tous les niveaux", "sous-classe", "groupe", "classe", "poste", "division",
)
ENTITIES = {
    "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&rsquo;": "’", "&agrave;": "à",
    "&acirc;": "â", "&ccedil;": "ç", "&egrave;": "è", "&eacute;": "é", "&ecirc;": "ê", "&icirc;": "î", "&ocirc;": "ô",
    "&ugrave;": "ù", "&ucirc;": "û", "&oelig;": "œ", "&euro;": "€", "&amp;": "&",
}
MAX_DESCRIPTION_LINES = 5


#: Elements whose inside isn't markup, and those that may hold one another; both are dropped.
RAW_ELEMENTS, NESTED_ELEMENTS = DROPPED_ELEMENTS[:2], DROPPED_ELEMENTS[2:]
#: Comments and elements whose inside isn't markup.
RAW_PATTERN = "(?is)<!--.*?-->|" + "|".join(rf"<{name}\b[^>]*>.*?</{name}\s*>" for name in RAW_ELEMENTS)
#: The tags whose nesting decides what is content.
TAGS = "|".join(dict.fromkeys([*(element for element, _ in CONTENT_ELEMENTS), *NESTED_ELEMENTS]))


def opening_pattern(element: str, css_class: str) -> str:
    """A text that starts with an opening tag of the element (of the class, if any)."""
    named = rf"[^>]*\bclass\s*=\s*[\x22'][^\x22'>]*\b{css_class}\b[^>]*" if css_class else r"[^>]*"
    return rf"(?is)^<{element}\b{named}>"


def _step(part: Column, names: str) -> Column:
    """1 where the part starts with an opening tag of the elements, -1 with a closing one."""
    return F.when(part.rlike(rf"(?i)^<({names})\b"), 1).when(part.rlike(rf"(?i)^</({names})\b"), -1).otherwise(0)


def _outside(parts: Column) -> Column:
    """The parts that lie in none of the nested dropped elements."""
    names = "|".join(NESTED_ELEMENTS)

    def deeper(state: Column, part: Column) -> Column:
        depth = F.greatest(state["depth"] + _step(part, names), F.lit(0))
        return let(depth, lambda d: F.struct(d.alias("depth"), F.concat(state["marks"], F.when(d == 0, "1").otherwise("0")).alias("marks")))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("marks"))
    marks = F.aggregate(parts, start, deeper, lambda state: F.split(state["marks"], ""))
    kept = let(marks, lambda mark: F.filter(parts, lambda part, i: F.get(mark, i) == "1"))
    return F.when(F.exists(parts, lambda part: part.rlike(rf"(?i)^<({names})\b")), kept).otherwise(parts)


def _inside(parts: Column, element: str, css_class: str) -> Column:
    """Markup inside the first such element, up to its own closing tag or the end of the page; NULL when empty or not there."""
    def walk(state: Column, part: Column) -> Column:
        opens = part.rlike(opening_pattern(element, css_class))
        depth = F.when(state["begin"] > 0, state["depth"] + F.when(state["end"] > 0, 0).otherwise(_step(part, element))).otherwise(F.when(opens, 1).otherwise(0))
        at = state["at"] + 1
        return let(depth, lambda d: F.struct(
            at.alias("at"), d.alias("depth"), F.when((state["begin"] == 0) & (d > 0), at).otherwise(state["begin"]).alias("begin"),
            F.when((state["begin"] > 0) & (state["end"] == 0) & (d == 0), at).otherwise(state["end"]).alias("end")))

    start = F.struct(*[F.lit(0).alias(name) for name in ("at", "depth", "begin", "end")])
    found = F.aggregate(parts, start, walk)
    inside = let(found, lambda f: F.slice(parts, f["begin"], F.when(f["end"] > 0, f["end"]).otherwise(f["at"] + 1) - f["begin"]))
    text = F.regexp_replace(F.array_join(inside, ""), r"^<[^>]*>", "")
    return F.when(F.exists(parts, lambda part: part.rlike(opening_pattern(element, css_class))), F.nullif(text, F.lit("")))


def content_markup(html: Column) -> Column:
    """Markup of the page's content: the first of `CONTENT_ELEMENTS` that is there and not empty, else the whole page.

    The page is cut once before every tag that matters; depths are counted along the parts, so an element ends at its own
    closing tag whatever it contains, and what stands in navigation, headers and footers is left out at any depth.
    """
    parts = F.split(F.regexp_replace(html, RAW_PATTERN, ""), rf"(?i)(?=</?(?:{TAGS})\b)")
    return let(parts, lambda cut: let(_outside(cut), lambda kept: F.coalesce(
        *[_inside(kept, *element) for element in CONTENT_ELEMENTS], F.array_join(kept, ""))))


def numeric_entities(text: Column) -> Column:
    """Decode `&#n;` and `&#xn;`; numbers that are no character stay as they are."""
    def character(code: Column) -> Column:
        number = F.when(F.lower(F.substring(code, 1, 1)) == "x", F.conv(F.substr(code, F.lit(2)), 16, 10)).otherwise(code).cast("long")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))

    codes = F.array_distinct(F.regexp_extract_all(text, F.lit("&#([0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"), F.lit(1)))
    return F.aggregate(codes, text, lambda done, code: F.coalesce(
        F.replace(done, F.concat(F.lit("&#"), code, F.lit(";")), character(code)), done))


def _decoded(text: Column) -> Column:
    """Numeric entities, then the listed named ones."""
    result = numeric_entities(text)
    for entity, character in ENTITIES.items():
        result = F.replace(result, F.lit(entity), F.lit(character))
    return result


def page_lines(html: Column) -> Column:
    """Text lines of the main content, white space squeezed, of three characters or more."""
    plain = let(content_markup(html), lambda markup: F.regexp_replace(markup, r"(?s)<[^>]*>", "\n"))
    content = let(plain, lambda text: F.when(F.contains(text, F.lit("&")), let(text, _decoded)).otherwise(text))
    return F.filter(F.transform(F.split(content, "\n"), squeeze_ws), lambda line: F.length(line) >= 3)


def _any_of(words: tuple[str, ...]) -> str:
    return "|".join(re.escape(word) for word in words)


def _marked(line: Column) -> Column:
    """The line with what it is: `excludes`, `includes` (unless it excludes), `navigates`."""
    def judged(lower: Column) -> Column:
        excludes = lower.rlike(_any_of(EXCLUSION_PHRASES))
        includes = F.contains(lower, F.lit(INCLUSION_WORD)) & lower.rlike(INCLUSION_PATTERN) & ~excludes
        navigates = lower.rlike(_any_of(NAVIGATION_WORDS)) | line.rlike(r"^\d+$|^\d{4}-\d{2}-\d{2}")
        return F.struct(line.alias("line"), excludes.alias("excludes"), includes.alias("includes"), navigates.alias("navigates"))

    return let(F.lower(line), judged)


def _first(lines: Column, test: str) -> Column:
    """0-based position of the first line that passes, beyond the end when none does."""
    position = F.array_position(lines[test], F.lit(True)).cast("int")
    return let(position, lambda at: F.when(at > 0, at - 1).otherwise(F.size(lines)))


def page_sections(pages: DataFrame, html: str = "html", code: str = "code") -> DataFrame:
    """Add `description, comprend, ne_comprend_pas`, NULL when empty.

    A page is read in three parts: up to the first phrase of inclusion, up to the first of exclusion, and the rest.
    Such a line itself contributes what follows its colon. Navigation, numbers and dates are skipped.
    """
    def bare(line: Column) -> Column:
        dated = line.rlike(r"\d{2}/\d{4}|\d{4}-\d{2}")
        plain = F.trim(F.regexp_replace(F.trim(F.regexp_replace(line, r"\d{4}-\d{2}-\d{2}T[\d:.+]+", "")), r":\s*\d{2}/\d{2}/\d{4}", ""))
        return F.when(dated, plain).otherwise(F.trim(line))

    def classified(row: Column, i: Column, at: Column) -> Column:
        line = row["line"]
        marker = row["excludes"] | (row["includes"] & (i < at["out"]))
        section = (
            F.when(row["excludes"] | (i > at["out"]), F.lit("ne_comprend_pas"))
            .when(row["includes"] | (i > at["in"]), F.lit("comprend")).otherwise(F.lit("description"))
        )
        after_colon = F.when(F.contains(line, F.lit(":")), F.trim(F.regexp_replace(line, r"^[^:]*:", "")))
        described = (i < at["in"]) & (i < at["out"])
        kept = let(bare(line), lambda plain: F.when(~described | ((F.length(plain) > 10) & ~plain.startswith(F.col(code))), plain))
        content = F.when(marker, after_colon).when(~row["navigates"], kept)
        return F.struct(section.alias("section"), F.nullif(content, F.lit("")).alias("content"))

    lines = F.transform(page_lines(F.col(html)), _marked)
    rows = let(lines, lambda marked: let(
        F.struct(_first(marked, "excludes").alias("out"), _first(marked, "includes").alias("in")),
        lambda at: F.filter(F.transform(marked, lambda row, i: classified(row, i, at)), lambda row: row["content"].isNotNull())))

    def joined(name: str, limit: int | None = None) -> Column:
        kept = F.filter("__rows", lambda row: row["section"] == name)["content"]
        return F.nullif(F.array_join(F.slice(kept, 1, limit) if limit else kept, " "), F.lit(""))

    return pages.withColumn("__rows", rows).withColumns({
        "description": joined("description", MAX_DESCRIPTION_LINES), "comprend": joined("comprend"),
        "ne_comprend_pas": joined("ne_comprend_pas"),
    }).drop("__rows")


def attach_descriptions(taxonomy: DataFrame, sections: DataFrame) -> DataFrame:
    """Taxonomy rows with the sections of their page, NULL when there is none."""
    texts = sections.select("code", "description", "comprend", "ne_comprend_pas")
    return taxonomy.join(texts, "code", "left")


def description_coverage(df: DataFrame) -> DataFrame:
    """Codes, and how many have a description and an inclusion text."""
    return df.agg(F.count("*").alias("n"), F.count("description").alias("n_description"), F.count("comprend").alias("n_comprend"))
