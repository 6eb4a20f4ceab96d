import itertools
import os

import pytest

SF = "/root/testdata/sf0.001"

#: Columns that operators use inside; a table may have its own of these names.
CLASHING = ["size", "digest", "kept", "shard", "node", "component", "hash", "key", "value", "label", "batch", "rid", "n", "keep_id"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)

WORDS = ["".join(p) for p in itertools.product("bdfgklmn", "aeiou", "rst")]


def prose(seed: int, n: int) -> str:
    """A repeatable text of ``n`` words."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x // 65536 % len(WORDS)])
    return " ".join(out)


def edge_texts() -> list[tuple]:
    """(doc_id, text): nulls, empty, blank, one word, copies, near copies, very long, odd characters."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join([*words[:-2], "changed", *words[-1:]])
    rows = [(1, base), (2, base), (3, near), (4, base.upper()), (5, base.replace(" ", "\t \n")), (6, None), (7, ""), (8, " \n\t "),
            (9, "one"), (10, "ONE"), (11, "two words"), (12, prose(2, 30_000)), (13, prose(3, 200) + "\n" + "same line"),
            (14, "naïve 中文 🙂 ▁ \x1c\x0b tail\r"), (None, base), (None, "no id at all " + prose(5, 40)), (15, prose(6, 60)), (15, prose(6, 60)),
            (16, "<|endoftext|> it's a 3rd test"), (17, "é" * 5000)]
    return rows + [(100 + i, prose(50 + i, 40 + i) + "\nsame line\n  Same LINE  ") for i in range(12)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    rows = [(i, t, "en" if t else None, f"src{(i or 0) % 3}", len(t or ""), *["x"] * len(CLASHING)) for i, t in edge_texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf():
    assert os.path.isdir(SF)
    return SF
