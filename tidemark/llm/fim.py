"""Fill-in-middle: a text cut in three by two seeded unit offsets and put together again with the middle last.

Units are runs of ASCII letters and single other characters, over code points. One Arrow-batched function collects the
units' end offsets of a text in a compact array, so that a cut is a lookup of two offsets and two slices. Seeds come
from a digest of the document's id; the same id and text always give the same output, whatever the partitions.

Defined results: a null text is empty, and an empty text is plain (as one that contains a marker is, since its output
could not be taken apart again); a null id has the empty text in the seed's place of the number; repeated rows, ties and
extra columns stay as they are (new columns replace those of the same name); texts are taken whole, however long; an
empty table gives an empty table with the same columns.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from operator import methodcaller

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units, markers of prefix, suffix and middle, and shares of forms in hundredths.
UNIT = r"[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
CUT_PER_CENT, SPM_PER_CENT = 90, 20

_end = methodcaller("end")
CUT = "n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"
REBUILT = "text string, sha256 string"


def unit_ends(text: str, unit: regex.Pattern) -> array:
    """Where each unit of the text ends: four bytes a unit, eight in a text beyond their range."""
    return array("I" if len(text) < 1 << 32 else "Q", map(_end, unit.finditer(text)))


def seeds(version: int, key: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{version}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def cut(text: str, key: str, unit: regex.Pattern, version: int = 1) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = unit_ends(text, unit)
    n = len(ends)
    a, b, plain, spm = seeds(version, key)
    if not text or any(m in text for m in MARKERS) or plain % 100 >= CUT_PER_CENT:
        return n, "plain", None, None, text
    a, b = sorted((a % (n + 1), b % (n + 1)))
    i, j = (ends[k - 1] if k else 0 for k in (a, b))
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if spm % 100 < SPM_PER_CENT:
        return n, "spm", i, j - i, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", i, j - i, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def rebuilt(output: str, form: str) -> str:
    """The text that an output was made of. No marker is in the text, and none can arise where parts meet."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, _, middle = output.removeprefix(first).partition(MIDDLE)
    one, _, two = head.partition(second)
    return one + middle + two if form == "psm" else two + middle + one


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", version: int = 1) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars (null if plain), output and output_sha256."""

    @F.pandas_udf(CUT)
    def cut_all(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        unit, names = regex.compile(UNIT), [c.split()[0] for c in CUT.split(", ")]
        for texts, keys in parts:
            rows = [cut(t, k, unit, version) for t, k in zip(texts, keys)]
            out = pd.DataFrame([(*r, _sha(r[-1])) for r in rows], columns=names)
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    got = cut_all(F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(key).cast("string"), F.lit("")))
    added = [c.split()[0] for c in CUT.split(", ")]
    rest = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in added]
    return docs.select(F.struct("*").alias("doc"), got.alias("cut")).select(*rest, "cut.*")


def restore(rows: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``rows`` with restored_text and restored_sha256, from output and form alone."""

    @F.pandas_udf(REBUILT)
    def rebuild(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for outputs, forms in parts:
            texts = [rebuilt(o, f) for o, f in zip(outputs, forms)]
            yield pd.DataFrame({"text": texts, "sha256": [_sha(t) for t in texts]}, dtype=object)

    got = rebuild(F.coalesce(output, F.lit("")), F.coalesce(form, F.lit("plain")))
    rest = [F.col(f"row.`{c}`").alias(c) for c in rows.columns if c not in ("restored_text", "restored_sha256")]
    return rows.select(F.struct("*").alias("row"), got.alias("back")).select(*rest, F.col("back.text").alias("restored_text"), F.col("back.sha256").alias("restored_sha256"))
