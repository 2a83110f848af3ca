"""Small documents with every odd case, and plain re-statements of the contracts."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, doc string, fp string, kept string, size string"


def word_list(text):
    return WORD.findall(text or "")


def sentence(rng, n, lang="en"):
    stock = {"en": "the of and ing er tion th in on he at re".split(), "fr": "le de que eau oi aux ment ré è une les ou".split(),
             "de": "der und sch ung keit ein ß ü zu be lich ver".split(), "es": "ción el los ñ ado que es mente ar ó ll de".split()}[lang]
    return " ".join("".join(rng.choice(stock) for _ in range(rng.randint(1, 3))) for _ in range(n))


def documents(seed=1, n=120):
    """Rows of SCHEMA: languages and sources (one hot, one null), copies, near copies, repeated rows, null, empty and long texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "fr", "de", "es"])
        text = sentence(rng, rng.choice([3, 60, 80, 120, 300]), lang)
        rows.append([i, text, lang, rng.choice(["s0"] * 4 + ["s1", "s2", None])])
    base = rows[5][1]
    rows += [[n + k, base, "en", "s0"] for k in range(9)]
    rows += [[n + 20 + k, rows[6][1].replace(" ", "  ", k % 3) + (" x" if k % 2 else ""), "en", "s0"] for k in range(9)]
    rows += [[n + 40, None, None, None], [n + 41, "", "en", "s1"], [n + 42, " \t\n\x0b", None, "s1"], [n + 43, "one two", "en", "s2"],
             [n + 44, sentence(rng, 30_000), "en", "s0"], [n + 45, "12345 !!! 67", "en", "s1"], [None, "no id here at all", "en", "s1"],
             [n + 46, "Ünï «ço» dé ¿qué? it's 3rd <|endoftext|> a,b. 日本語 е́ \u2003x", "en", "s2"]]
    rows += [list(rows[3]), list(rows[3]), [7, "another text under the same id", "en", "s1"]]
    return [tuple(r) + (0, "id", "doc", "fp", "kept", "size") for r in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)
