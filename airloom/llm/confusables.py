"""Visually identical text with different characters.

skeleton = decompose, replace each character by its prototype, decompose again.
Two texts look the same iff their skeletons are equal.  Prototypes of width
variants, styled letters, blanks and invisible characters come from rules over
the Unicode database; only look-alike letters are a list, which covers the
letters in use by feeds and the common ones of rarer scripts, not all of the
public confusables data.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that look like a Latin letter.
LOOK_ALIKE = {
    # Greek capitals and small letters
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "γ": "y", "ι": "i", "ν": "v", "ο": "o", "ρ": "p",
    "σ": "o", "υ": "u", "ϲ": "c", "Ϲ": "C", "ϳ": "j", "Ϳ": "J",
    # Cyrillic capitals and small letters
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԁ": "D", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x",
    "ү": "y", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v",
    # Armenian, Cherokee and others
    "Օ": "O", "օ": "o", "ս": "u", "ո": "n", "հ": "h", "ց": "g", "զ": "q", "Տ": "S", "Լ": "L",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮇ": "M", "Ꮲ": "P", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ɪ": "i", "ʋ": "u", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ᴄ": "c", "ꜱ": "s",
    # Punctuation
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "’": "'", "ʼ": "'", "′": "'", "‘": "'", "׀": "|", "∣": "|", "ǀ": "|", "։": ":", "∶": ":",
}


# Further look-alikes, of scripts that no feed's names are written in.
RARE = {
    # Cyrillic palochka and letters of old or small alphabets, Latin letters of phonetic and other use
    "Ӏ": "l", "ӏ": "l", "Ь": "b", "Һ": "h", "ҽ": "e", "ԁ": "d", "Ԛ": "Q", "ı": "i", "ȷ": "j", "ʏ": "y", "ƅ": "b", "ƽ": "s", "ᴀ": "A", "ᴅ": "D", "ᴇ": "E",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꮍ": "Y", "Ꮐ": "G", "Ꮒ": "h", "Ꮞ": "4", "Ꮟ": "b", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮪ": "S", "Ꮮ": "L", "Ꮷ": "d", "Ꮾ": "6", "Ᏻ": "G",
    # Coptic
    "Ⲁ": "A", "Ⲃ": "B", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "ⲟ": "o", "ⲣ": "p", "ⲥ": "c",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N", "ꓡ": "L", "ꓢ": "S", "ꓣ": "R",
    "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    # Armenian and runes
    "Ս": "U", "յ": "j", "ᚷ": "X", "ᛕ": "K",
}


@lru_cache(maxsize=1)
def prototypes() -> dict[int, str]:
    """Code point -> prototype, for str.translate after decomposition.

    ASCII letters, figures and marks are their own prototypes (I, l and 1 stay
    apart, for letter case and spelling alter the look).
    """
    out: dict[int, str] = {}
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        kind = unicodedata.category(c)
        if kind in ("Zs", "Zl", "Zp") or c in "\t\n\v\f\r\x85" or i in (0x3164, 0xFFA0, 0x2800):
            out[i] = " "
        elif kind in ("Cf", "Cc") or 0xFE00 <= i <= 0xFE0F or 0xE0100 <= i <= 0xE01EF or i == 0x34F:
            out[i] = ""  # invisible
        elif i >= 0x80 and (d := unicodedata.decomposition(c)):
            tag = d.split()[0]
            if tag in ("<wide>", "<narrow>", "<font>") or (tag == "<compat>" and kind in ("Ll", "Lu", "Nl")):
                out[i] = unicodedata.normalize("NFKC", c)
    out |= {ord(k): v for k, v in (LOOK_ALIKE | RARE).items()}
    # a compatibility form may lead to a letter that is itself in the list
    table = str.maketrans(LOOK_ALIKE | RARE)
    return {k: v.translate(table) for k, v in out.items()}


def skeleton_of(text: str) -> str:
    """Decomposed prototypes without outer blanks; the same path for all characters."""
    if text.isascii() and text.isprintable():
        return text.strip()  # the table leaves such texts as they are
    out = unicodedata.normalize("NFD", text).translate(prototypes())
    return unicodedata.normalize("NFD", out).strip()


def consistent_form(text: str) -> str:
    """The skeleton in composed form: one spelling for all texts that look alike."""
    return unicodedata.normalize("NFC", skeleton_of(text))


@F.pandas_udf(T.StringType())
def skeleton(texts: pd.Series) -> pd.Series:
    """NULL stays NULL, empty stays empty; texts of any length are processed whole."""
    memo: dict[str, str] = {}
    out = []
    for t in texts:
        if t is None:
            out.append(None)
            continue
        if (s := memo.get(t)) is None:
            s = skeleton_of(t)
            if len(t) < 200:
                memo[t] = s
        out.append(s)
    return pd.Series(out, dtype=object)


def look_alike_pairs(left: DataFrame, right: DataFrame, left_text: str, right_text: str) -> DataFrame:
    """Distinct rows of ``left`` x ``right`` whose texts look the same but differ in their characters.

    Column names of the two sides must differ.  Rows with NULL text match
    nothing; the empty text looks like a text of invisible characters only.
    Repeated rows are joined once.
    """
    a = left.filter(F.col(left_text).isNotNull()).distinct().withColumn("__skeleton", skeleton(left_text))
    b = right.filter(F.col(right_text).isNotNull()).distinct().withColumn("__skeleton_r", skeleton(right_text))
    pair = F.col("__skeleton") == F.col("__skeleton_r")
    return a.join(b, pair & (F.col(left_text) != F.col(right_text))).drop("__skeleton_r", "__skeleton")


def forms(texts: DataFrame, column: str) -> DataFrame:
    """Each distinct text with its consistent form, its count and the number of spellings of that form.

    Columns: text, form, n_rows, n_spellings.  Counts are made before any
    shuffle of texts; a form that holds many rows is one row per spelling.
    """
    each = texts.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("text")).agg(F.count("*").alias("n_rows"))
    each = each.withColumn("form", skeleton("text"))
    per = each.groupBy("form").agg(F.count("*").alias("n_spellings"))
    return each.join(per, "form").select("text", "form", "n_rows", "n_spellings")
