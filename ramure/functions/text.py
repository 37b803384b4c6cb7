"""Text cleaning as column expressions: no UDF, no shuffle, whole texts."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Romanisation of characters that don't decompose into one ASCII letter.
EXPANSIONS = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "Th", "þ": "th", "Ĳ": "IJ", "ĳ": "ij", "ŉ": "'n",
    "€": "EUR", "£": "PS", "¥": "Y=", "°": "deg", "©": "(c)", "®": "(r)", "™": "(tm)", "«": "<<", "»": ">>",
    "¢": "C/", "¤": "$?", "§": "SS", "¼": "1/4", "½": "1/2", "¾": "3/4", "…": "...", "—": "--", "±": "+-", "№": "No",
}
# Characters that map to one ASCII character but have no decomposition.
SINGLES = {
    "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ł": "L", "ł": "l",
    "Ŋ": "N", "ŋ": "n", "Ŧ": "T", "ŧ": "t", "ĸ": "k", "ſ": "s", "Ŀ": "L", "ŀ": "l", "\u00a0": " ", "\u202f": " ",
    "\u2009": " ", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "‐": "-", "‑": "-", "•": "*", "·": "*", "×": "x",
    "÷": "/", "¹": "1", "²": "2", "³": "3", "º": "o", "ª": "a", "¿": "?", "¡": "!", "´": "'", "µ": "u",
    "¦": "|", "¨": '"', "¬": "!", "¯": "-", "¶": "P", "¸": ",",
}


def _single_letters() -> dict[str, str]:
    """Latin letters (Latin-1, Extended-A, -B and Additional) whose canonical decomposition starts with an ASCII letter."""
    table = {}
    for point in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(point))[0]
        if base != chr(point) and base.isascii():
            table[chr(point)] = base
    table.update(SINGLES)
    return table


SINGLE_LETTERS = _single_letters()

# Short default; the production list is a file given to `load_stopwords`.
DEFAULT_STOPWORDS = ("de", "la", "le", "les", "du", "des")


def load_stopwords(spark: SparkSession, path: str) -> list[str]:
    """Stop words from a JSON array file on any storage Spark reaches; a few hundred words."""
    text = spark.read.text(path, wholetext=True).first()
    words = json.loads(text[0]) if text else []
    if not isinstance(words, list):
        raise ValueError(f"{path} must hold a JSON array of words")
    return [str(word) for word in words]


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _is_ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def _spelled_out(text: Column) -> Column:
    for sign, spelling in EXPANSIONS.items():
        text = F.replace(text, F.lit(sign), F.lit(spelling))
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def transliterate(column: Column | str) -> Column:
    """NULL to '', then ASCII: accents removed, ligatures and signs spelled out, the rest dropped."""
    text = F.coalesce(_col(column), F.lit(""))
    letters = F.translate(text, "".join(SINGLE_LETTERS), "".join(SINGLE_LETTERS.values()))
    # texts that are ASCII skip the letters, and those that are then ASCII skip the signs
    plain = let(letters, lambda t: F.when(_is_ascii(t), t).otherwise(_spelled_out(t)))
    return F.when(_is_ascii(text), text).otherwise(plain)


def _without_empty_label(text: Column) -> Column:
    """Drop the words that say a label is empty; the cheap search first, as few texts have them."""
    there = F.contains(text, F.lit("rien")) | F.contains(text, F.lit("\rien"))
    return F.when(there, F.regexp_replace(text, r"\brien\b|\rien du tout\b", "")).otherwise(text)


def _clean_tokens(text: Column) -> Column:
    """Words longer than one character left after the noise steps, in order."""
    text = let(text, _without_empty_label)
    text = let(F.regexp_replace(text, r"[^\w\s]+", " "), _without_empty_label)
    # digits, plus signs and white space all end a word
    words = F.split(F.regexp_replace(text, r"[\d+\s]+", " "), " ")
    return F.filter(words, lambda word: F.length(word) > 1)


def strip_noise(column: Column | str) -> Column:
    """Remove the empty label, punctuation, digits and one-letter words; one space between words."""
    return F.array_join(_clean_tokens(_col(column)), " ")


def dedup_tokens(column: Column | str) -> Column:
    """Keep the first occurrence of each word, in order."""
    return F.array_join(F.array_distinct(_words(_col(column))), " ")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda word: word != "")


def remove_stopwords(column: Column | str, words: Sequence[str]) -> Column:
    """Drop the words of the list; repeated other words stay."""
    tokens = _words(_col(column))
    if not words:
        return F.array_join(tokens, " ")
    return F.array_join(F.filter(tokens, lambda word: ~word.isin(*words)), " ")


def drop_empty(df: DataFrame, column: str) -> DataFrame:
    """Trim the column and drop rows where nothing is left."""
    trimmed = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    return df.withColumn(column, trimmed).where(F.col(column) != "")


def cleaned_tokens(column: Column | str) -> Column:
    """Array of distinct clean words before stop words are removed."""
    return F.array_distinct(_clean_tokens(F.lower(transliterate(column))))


def preprocess_text(df: DataFrame, column: str, words: Sequence[str] = DEFAULT_STOPWORDS) -> DataFrame:
    """Clean `column`, keep the original as `<column>_orig`, drop rows without any word.

    Stop words go last, so a text of stop words only becomes '' and its row stays. One narrow stage:
    the tokens are computed once per row and the empty arrays are dropped by the flattening itself.
    """
    original, tokens = f"{column}_orig", "__tokens"
    kept = F.filter(F.array(cleaned_tokens(column)), lambda words_of_row: F.size(words_of_row) > 0)
    others = [name for name in df.columns if name not in (column, original)]
    flat = df.select(*others, F.col(column).alias(original), F.explode(kept).alias(tokens))
    final = F.col(tokens)
    if words:
        final = F.filter(final, lambda word: ~word.isin(*words))
    order = [name for name in df.columns if name != original] + [original]
    return flat.withColumn(column, F.array_join(final, " ")).select(*order)


def squeeze_ws(column: Column | str) -> Column:
    """Collapse every run of white space, no-break spaces included, and trim."""
    return F.trim(F.regexp_replace(_col(column), r"(?U)\s+", " "))


def parse_amount(column: Column | str) -> Column:
    """Number with a comma or dot as decimal sign; NULL when it isn't one."""
    text = F.replace(F.trim(_col(column)), F.lit(","), F.lit("."))
    numeric = text.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$")
    return F.when(numeric, text.try_cast("double"))


def text_length(column: Column | str) -> Column:
    return F.length(_col(column))


def word_count(column: Column | str) -> Column:
    return F.size(_words(_col(column)))
