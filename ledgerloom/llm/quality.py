"""Quality rules, line first.

Each line of a document is judged by rules on punctuation, navigation and boilerplate; lines that fail are removed, and
a document that loses too much of its text goes. Base rules on counts of words and repeats come before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import column_after, text_slices, unclash

#: Characters that count as symbols, and that may end a sentence.
SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?…:;\"'”’»)]}。！？"
#: Separators of menu entries, and phrases of page furniture (in short lines only).
SEPARATORS = re.compile(r"\s[|•·»›>/]\s|\s[|•·»›>/]$|^[|•·»›>/]\s")
FURNITURE = re.compile(
    r"cookie|javascript|privacy policy|terms of (?:use|service)|all rights reserved|sign (?:in|up)|log ?in\b|subscribe"
    r"|click here|read more|back to top|skip to (?:main )?content|lorem ipsum|share (?:this|on)|powered by"
    r"|datenschutz|impressum|mentions légales|aviso legal|política de privacidad",
    re.IGNORECASE,
)
WHITE = "\t\n\x0b\x0c\r "


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules."""

    min_words: int = 50
    max_repeat_percent: int = 50
    menu_separators: int = 2
    entry_words: int = 6
    furniture_words: int = 20
    symbols_per_word: float = 0.1
    fragment_words: int = 12
    max_lost: float = 0.4


RULES = QualityRules()


def line_fails(line: str, rules: QualityRules = RULES) -> str:
    """The rule by which a line fails, or nothing: punctuation (symbols in place of words, or a fragment without a mark at
    its end), navigation (separators between entries of few words in the mean), boilerplate (a short line with a phrase of page furniture). Blank lines pass."""
    bare = line.strip(WHITE)
    if not bare:
        return ""
    words = bare.split()
    separators = len(SEPARATORS.findall(bare))
    if separators >= rules.menu_separators and len(words) - separators <= rules.entry_words * (separators + 1):
        return "navigation"
    if len(words) <= rules.furniture_words and FURNITURE.search(bare):
        return "boilerplate"
    if sum(map(bare.count, SYMBOLS)) > rules.symbols_per_word * len(words):
        return "punctuation"
    return "" if bare[-1] in TERMINAL or len(words) > rules.fragment_words else "punctuation"


def clean_lines(text: str, rules: QualityRules = RULES) -> tuple[str, float]:
    """The text without its failing lines, and the share of its characters in words that went with them."""
    kept, lost, total = [], 0, 0
    for line in text.split("\n"):
        n = sum(map(len, line.split()))
        total += n
        if line_fails(line, rules):
            lost += n
        else:
            kept.append(line)
    return "\n".join(kept), lost / total if total else 0.0


def repeated_words(codes: np.ndarray, doc: np.ndarray, n_docs: int, window: int = 3) -> np.ndarray:
    """Per document, the words inside windows of `window` words that occur twice or more in it. doc: of each word."""
    out = np.zeros(n_docs, np.int64)
    n = len(codes)
    if n < window:
        return out
    keys = codes[: n - window + 1].astype(np.int64)
    for i in range(1, window):
        # numbers of the distinct prefixes so far, so that a pair of numbers fits in 64 bits
        keys = pd.factorize(keys * (int(codes.max()) + 1) + codes[i : n - window + 1 + i])[0]
    inside = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
    if not len(inside):
        return out
    numbers, _ = pd.factorize(doc[inside].astype(np.int64) * (int(keys.max()) + 1) + keys[inside])
    again = inside[np.bincount(numbers)[numbers] > 1]
    covered = np.zeros(n, bool)
    for i in range(window):
        covered[again + i] = True
    return out + np.bincount(doc[covered], minlength=n_docs)


def measure(texts: list[str | None], rules: QualityRules = RULES) -> dict[str, list]:
    """The columns of quality() for some texts."""
    whole = [t or "" for t in texts]
    words = [t.encode().split() for t in whole]  # bytes.split() splits at space and \t to \r alone
    counts = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(len(whole)), counts)
    flat = np.fromiter((w for ws in words for w in ws), object, int(counts.sum()))
    repeats = repeated_words(pd.factorize(flat)[0], doc, len(whole)) if len(flat) else np.zeros(len(whole), np.int64)
    out: dict[str, list] = {"n_words": counts.tolist(), "n_repeat_words": repeats.tolist()}
    out["word_chars"] = [len(t) - sum(map(t.count, WHITE)) for t in whole]
    out["n_symbols"] = [sum(map(t.count, SYMBOLS)) for t in whole]
    dup = []
    for t in whole:
        lines = [x for x in t.split("\n") if x.strip(WHITE)]
        dup.append(len(lines) - len(set(lines)))
    out["n_dup_lines"] = dup
    out["base_failed"] = [n < rules.min_words or 100 * r > rules.max_repeat_percent * n for n, r in zip(out["n_words"], out["n_repeat_words"], strict=True)]
    cleaned = [clean_lines(t, rules) for t in whole]
    out["clean_text"] = [None if t is None else c for t, (c, _) in zip(texts, cleaned, strict=True)]
    out["lost"] = [x for _, x in cleaned]
    out["kept"] = [not bad and x <= rules.max_lost for bad, x in zip(out["base_failed"], out["lost"], strict=True)]
    return out


MEASURES = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"), ("clean_text", "string"), ("lost", "double"), ("kept", "boolean"))


def quality(docs: DataFrame, text: str = "text", rules: QualityRules = RULES) -> DataFrame:
    """`docs` with its measures, the cleaned text and the verdict `kept`, row by row.

    A null text has no words, fails the base rules and has a null clean_text. Columns of `docs` with the names of the
    measures get an underscore before them; if `text` is one of those, it is still the one that is read. Repeated rows are judged alike; texts of any length are judged whole; an empty table
    gives no rows.
    """
    names = [n for n, _ in MEASURES]
    docs, moved = unclash(docs, names)
    text = column_after(moved, text)
    schema = T.StructType([*docs.schema, *T._parse_datatype_string(", ".join(f"{n} {t}" for n, t in MEASURES))])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, text):
            found = measure(texts, rules)
            kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(found[n], kinds[t]) for n, t in MEASURES)], [*batch.schema.names, *names])

    return docs.mapInArrow(judge, schema)


def keep_quality(docs: DataFrame, text: str = "text", rules: QualityRules = RULES) -> DataFrame:
    """The documents that are kept, without their failing lines and with the columns of `docs`; n_chars follows the text."""
    safe, moved = unclash(docs, [n for n, _ in MEASURES])
    own = column_after(moved, text)
    out = quality(safe, own, rules).filter("kept").withColumn(own, F.col("clean_text")).drop(*[n for n, _ in MEASURES]).withColumnsRenamed(moved)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.col(f"`{text}`")).cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
