"""Small documents tables for the tests of the operators."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, ids=None, clashing=()):
    """A table like ``documents``; ``clashing`` names extra columns that an operator uses itself."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src", len(t or "")) + ("x",) * len(clashing) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS + "".join(f", {name} string" for name in clashing))


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def lowered(text):
    return re.sub("[A-Z]", lambda found: found[0].lower(), text or "")


def shingles(text, width=5):
    words = WORDS.findall(lowered(text))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def similar(a, b, percent=80):
    return bool(a and b) and 100 * len(a & b) >= percent * len(a | b)


def least_reachable(ids, linked):
    """Per id the smallest id that links reach, by brute force."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def prose(random, count, vocabulary=400):
    """So many invented words."""
    return " ".join(f"w{random.randrange(vocabulary)}" for _ in range(count))
