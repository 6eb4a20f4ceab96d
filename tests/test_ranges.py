"""A JSON document cut anywhere gives the elements of the whole."""

import json
import random

import pytest

from panes.sources import ranges
from panes.sources.lines import read_documents
from panes.sources.ranges import ESCAPED, IN, OUT, array_elements, lex


def plain(text, state):
    """A byte at a time."""
    out, depths, depth = [], [], 0
    for b in text:
        c = chr(b)
        outside = state == OUT and c != '"'
        if state == ESCAPED:
            state = IN
        elif c == '"':
            state = IN if state == OUT else OUT
        elif c == "\\" and state == IN:
            state = ESCAPED
        if outside:
            depth += (c in "[{") - (c in "]}")
        out.append(outside)
        depths.append(depth)
    return out, depths, state


def test_the_automaton_is_that_of_a_byte_loop():
    r = random.Random(1)
    for _ in range(3000):
        # A backslash outside strings is no JSON; there the two may differ.
        text = "".join(r.choice('[]{},"\\ab') for _ in range(r.randint(0, 14))).encode()
        for state in (OUT, IN, ESCAPED):
            want = plain(text, state)
            inside = True
            for c, o in zip(text, want[0], strict=True):
                inside &= not (o and chr(c) == "\\")
            if not inside:
                continue
            _, outside, depth, end = lex(text, state)
            assert outside.tolist() == want[0] and depth.tolist() == want[1] and end == want[2], (text, state)


VALUES = [{"a": 'x],[{"\\'}, [], {}, [1, [2, [3, ","]]], "plain, text", 'say "hi"', "\\", '\\"', "é中🙂,", 12.5, None, True, {"k": {"k": ['"', "]"]}}, "x" * 700 + ",y"]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [17, 1 << 20])
def test_any_layout_at_any_cut(spark, scratch, indent, size):
    r = random.Random(size)
    docs = {"one": [r.choice(VALUES) for _ in range(25)], "none": [], "single": [VALUES[0]], "nested": [[], [[]], [1, 2]]}
    for name, doc in docs.items():
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(" \n" + json.dumps(doc, indent=indent, ensure_ascii=False) + " \n")
    got = sorted(json.dumps(json.loads(e.element)) for e in array_elements(spark, scratch, size).collect())
    assert got == sorted(json.dumps(x) for d in docs.values() for x in d)


def test_faults(spark, scratch):
    texts = {"good": "[1, 2]", "open": '[1, {"a": 2]', "string": '["a, b]', "object": '{"a": [1, 2]}'}
    for name, text in texts.items():
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(text)
    assert sorted(r.element.strip() for r in array_elements(spark, scratch, 3, mode="permissive").collect()) == ["1", "2"]
    for name in ("open", "string", "object"):
        with pytest.raises(ValueError, match=f"{name}.json"):
            array_elements(spark, f"{scratch}/{name}.json", 3)
    with open(f"{scratch}/bad.txt", "w") as f:
        f.write("[1, oops]")
    with pytest.raises(Exception, match="oops|MALFORMED"):
        read_documents(spark, f"{scratch}/bad.txt", layout="ranges").collect()
    with pytest.raises(ValueError, match="stream"):
        read_documents(spark, scratch, layout="ranges", stream=True)


def test_a_document_is_read_by_many_tasks(spark, scratch):
    with open(f"{scratch}/doc.json", "w") as f:
        json.dump([{"i": i, "text": "a, [b" * 5} for i in range(2000)], f, indent=1)
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    pieces = own.read.option("lineSep", ",").text(scratch).select("_metadata.file_path", "_metadata.file_block_start", "value")
    maps = pieces.mapInArrow(ranges.range_maps, ranges._MAPS).collect()
    assert len(maps) >= 8 and all(len(m["ends"]) == 3 for m in maps)
    rows = read_documents(spark, scratch, "i long, text string", layout="ranges", range_bytes=8192).collect()
    assert sorted(r.i for r in rows) == list(range(2000)) and {r.text for r in rows} == {"a, [b" * 5}
