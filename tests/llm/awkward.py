"""Documents with nulls, empty and very long texts, ties, repeated rows and clashing column names."""

import random

FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, key string, chunk bigint, node bigint, ids string, h1 int, rest string" + ", _ok string, _score int, _leaks string, _null int, _low string, _row1 int, _row2 string, others string, none int, `a b` string, m map<string,int>"


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("th", "on", "re", "Ä", "漢") for b in ("en", "at", "ing", "ß", "")] + ["A", "a", "—", " "]
    texts: list = [None, "", " \t\n", "one", "one two", "ONE two", "\x00 odd", "tail  "]
    for _ in range(n):
        texts.append(rng.choice([" ", "  ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 80))))
    base = " ".join(rng.choice(vocabulary) + str(i % 7) for i in range(90))
    texts += [base, base, base + " end", "start " + base, base[:300], base * 3, "a" * 700, "a " * 400]
    texts.append(" ".join(rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(60_000)))
    out = []
    for i, t in enumerate(texts):
        lang = rng.choice(["en", "de", None])
        out.append((i * 3 % 101, t, lang, None if i % 5 == 0 else "s", None, i, "k", 1, 2, "x", 3, "r"))
    out += [out[12], out[12]]  # repeated rows
    out += [(None, "a document without id", "en", "s", 1, 0, "k", 1, 2, "x", 3, "r"), (None, base, None, None, None, 0, None, None, None, None, None, None)]
    out.append((out[20][0], "another text under the same id " + base, "en", "s", 1, 0, "k", 1, 2, "x", 3, "r"))
    # Names that operators use themselves; each row can be told by them.
    return [(*row, f"ok{i}", i, "leak", i % 3, "low", 7, "r2", "o", None, "a b", {"k": i}) for row in out for i in [out.index(row)]]
