"""Small documents that hold the awkward cases, and plain versions of the word patterns."""

from __future__ import annotations

import random
import re

from pyspark.sql import SparkSession

# columns of the given table, and names that operators use inside
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, copies string, batch long, "
          "class string, rep double, row string, mix string, cell long, block int, text_hash string, key string, p_toxic string")


def words(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abdeilmnorstu") for _ in range(r.randrange(2, 8))) for _ in range(n))


PASSAGE = "Alpha beta gamma delta epsilon zeta. " + words(30, 99) + ". Omega psi chi phi upsilon tau."
A, B = words(80, 1), words(120, 2)


def documents() -> list[tuple]:
    long = " ".join(words(400, 50 + i) for i in range(40)) + " " + PASSAGE
    texts = [
        (10, A), (11, A), (12, A.replace(A.split()[40], "changed", 1)), (13, A.upper()), (14, B), (15, B + " " + PASSAGE),
        (16, PASSAGE + " " + words(20, 3)), (17, None), (18, ""), (19, "  \n\t "), (20, "Hello"), (21, "hello there"),
        (22, "one. two. three. four. one. two. three. four."), (23, "one. two! three? four"), (24, "a" * 300), (25, "a" * 60),
        (26, "ab " * 150), (27, long), (28, "Éa ñandú ß 日本 語　x y z 🙂 \u0085 don't we're I'll  two  spaces\r\nline"),
        (29, words(60, 4) + " scum moron idiot"), (30, "!!! ... ???"), (31, B), (31, B), (None, words(30, 5)),
        (None, A), (9, PASSAGE), (33, "Licensed under the Apache License, Version 2.0. " + words(40, 6)),
        (34, words(40, 7) + "\nReleased under the MIT License.\n" + words(10, 8)), (-5, words(3, 9)),
        (2**62, words(12, 10)), (35, "x\x00y z"), (36, words(9, 11)),
    ]
    sources = ["s1", None, "s2", "é", "S3", "s1", ""]
    return [(i, t, None if n % 5 == 0 else "en", sources[n % 7], n, n, "c", 0, "k", 0.5, "r", "m", 1, 2, "h", None, "p")
            for n, (i, t) in enumerate(texts)]


def frame(spark: SparkSession, rows: list[tuple] | None = None, parts: int = 3):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
