"""Small corpora with the awkward cases, and slow definitions to hold results against."""

import random

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def corpus(seed=1, families=12):
    """Families of near copies of falling similarity, plus nulls, blanks, short, long and repeated rows."""
    rng = random.Random(seed)
    rows = []

    def add(text, lang="en", source=None):
        rows.append((len(rows), text, lang, source or f"s{rng.randrange(3)}", None if text is None else len(text)))

    for _ in range(families):
        base = words(rng, rng.randrange(30, 120))
        for edits in (0, 0, 1, 2, 3, 4, 6, 9):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            add(" ".join(copy).upper() if edits == 1 else " ".join(copy))
    for text in (None, None, "", "  \n\t ", "one", "ONE", "a b c d", "a b c d e", "é ß ñ 字 ſ K", "\n\n"):
        add(text)
    add(" ".join(words(rng, 30_000)))
    add("z" * 700_000)
    rows.append((None, "an orphan without an id at all", None, None, None))
    rows.append((None, None, None, None, None))
    rows.append(rows[3])
    rows.append(rows[3])
    rng.shuffle(rows)
    return rows


def shingles(text):
    table = {chr(c): chr(c + 32) for c in range(65, 91)}
    lowered = "".join(table.get(c, c) for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    own = [w for w in lowered.split(" ") if w]
    if not own:
        return set()
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))}


def with_clashes(df, *names):
    """Extra columns under names that an operator may use itself."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(n) for n in names if n not in df.columns})
