"""Small documents with every odd case: null and empty values, ties, repeated rows, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, component_id long, DOC string"
WORDS = {"en": "the of and house tree water with from", "fr": "le de et maison arbre eau avec dans"}


def prose(seed: int, n: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    words = WORDS[lang].split() + [f"{lang}{rng.choice('abcdefgh')}{rng.choice('klmnop')}" for _ in range(30)]
    return " ".join(rng.choice(words) for _ in range(n))


def rows() -> list[tuple]:
    out = []
    for i in range(60):
        lang = ("en", "fr")[i % 2]
        text = prose(i, 20 + 7 * (i % 9), lang)
        if i % 6 == 5:
            text = " ".join(w + "%%%" for w in text.split())
        out.append((i, text, lang, f"s{i % 4}" if i % 11 else None, len(text), None, "x", 7, "d"))
    base = prose(500, 120)
    near = base.split()
    near[60] = "changed"
    out += [
        (100, base, "en", "s0", 1, 0.1, None, None, None),
        (101, base.upper(), None, "s1", 1, None, None, None, None),
        (102, " ".join(near), "en", "s1", None, None, None, None, None),
        (103, None, "en", "s2", None, None, None, None, None),
        (104, "", None, None, 0, None, None, None, None),
        (105, " \n\t ", "en", "s2", 4, None, None, None, None),
        (106, "12 34 ...", "en", "s2", 9, None, None, None, None),
        (107, "one two", "en", "s3", 7, None, None, None, None),
        (108, "One  two", "en", "s3", 8, None, None, None, None),
        (109, prose(501, 6000) + "\n" + "x" * 5000, "en", "s3", 1, None, None, None, None),
        (None, base, "en", "s0", 1, None, None, None, None),
    ]
    out += [(110, "the same row again and again", "en", "s1", 28, 0.5, "y", 1, "z")] * 3
    return out


def documents(spark, only=None):
    return spark.createDataFrame(rows() if only is None else only, SCHEMA)
