"""Small documents with every odd case, and plain versions of what words are."""

import random
import re

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def prose(rng, n, vocabulary=300):
    return " ".join(f"{rng.choice('aeiouäß')}{rng.randrange(vocabulary):x}{rng.choice(['', '', '', ',', '.'])}" for _ in range(n))


def odd_texts():
    """Null, empty, blanks, odd characters, a long text, copies and near-copies."""
    rng = random.Random(7)
    base = prose(rng, 400)
    words = base.split(" ")
    near = words[:]
    near[200] = "changed"
    passage = prose(rng, 62)
    texts = [
        None, "", "   \n\t ", "one", "two words", "Ünïcode — ÄÖ ß İstanbul Σίσυφος 漢字 🙂", base, base, " ".join(near), base.upper(), prose(rng, 30) + " " + passage + " " + prose(rng, 40),
        prose(rng, 70) + " " + passage, "\n".join(["same line here."] * 5), "x " * 120, " | ".join(f"Link{i}" for i in range(80)), "$$$ " * 60 + prose(rng, 20), prose(rng, 9000), "a\x00b\x01c d\x1ce <|endoftext|> it's",
        "All rights reserved. CC-BY cc by cc by", "Released under the MIT License.\n" + prose(rng, 60) + ".",
    ]
    return texts + [prose(rng, rng.randrange(1, 200)) for _ in range(20)]


def documents(spark, more=()):
    """The odd texts, a null id, and a row that comes twice; columns that clash with what operators add."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate([*odd_texts(), *more])]
    rows += [(None, "a document without an id", None, None, None), rows[6], rows[0]]
    return spark.createDataFrame(rows, COLUMNS)


def clashing(frame, *names):
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit("own") for n in names})
