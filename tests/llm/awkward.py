"""Rows that operators must get through: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

LONG = "lorem ipsum dolor " * 20_000
TEXTS = (None, "", " ", "\n\n", "a", "word " * 60, LONG, "naïve café 日本語 😀", "tab\tand\x0bform\x0cfeed\x1c\x85 end")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key long, fp long, bucket long, score double, `first` long, kind int, tokens long, place long, variant long, "
    "row long, epoch long, text_hash long, first_id long, first_hash long, component long, domain string, own_place long, "
    "cut long, leaf_lang string, at long, trusted boolean, taken_tokens long, ids binary"
)

MORE = (6, 7, 8, 9, None, 10, "d9", 11, 12, "x", None, True, 13, b"14")


def documents(spark, texts=TEXTS, lang="en"):
    """The texts twice under other ids, once more under a repeated id and once without an id."""
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t) for i, t in enumerate(texts)]
    rows += [(0, texts[-1]), (5, texts[5]), (None, texts[7]), (None, texts[7]), (None, None)]
    langs, sources = [lang, None], ["src0", "src1", None]
    made = [
        (i, t, langs[n % 7 == 3], sources[n % 3], None if t is None else len(t), 1, 2, None, 0.5, None, 3, 4, 5, None, *MORE)
        for n, (i, t) in enumerate(rows)
    ]
    return spark.createDataFrame(made, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def by_row(frame):
    """Rows as plain tuples, in any order."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
