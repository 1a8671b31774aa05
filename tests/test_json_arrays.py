import json
import random
import re

import pytest

from lake_ingest.sources import json_arrays as J
from tests.conftest import rows


def _cut(content, parts):
    """Pieces of the parts as the documents' functions, composed, have it."""
    state, depth, out = J.OUTSIDE, 0, []
    for part in parts:
        out += list(J.pieces_of(part, state, depth))
        after, change = J.part_function(part)[state]
        state, depth = after, depth + change
    return out


def _elements(pieces):
    out, held = [], b""
    for kind, text in pieces:
        assert kind != J.STRAY
        if kind == J.OPENING:
            continue
        if kind == J.WHOLE:
            out.append(text)
        else:
            held += text
            if kind == J.HEAD:
                out.append(held)
                held = b""
    return [e.strip() for e in out if e.strip()]


@pytest.mark.parametrize("seed", range(8))
def test_any_cuts_give_the_same_elements(seed):
    rng = random.Random(seed)
    texts = ["", '"', "\\", '\\"', "[", "],", "{", "é", "a,b", "\n", "\\\\"]

    def value(depth):
        kind = rng.randrange(4 if depth else 2)
        if kind == 0:
            return "".join(rng.choice(texts) for _ in range(rng.randint(0, 6)))
        if kind == 1:
            return rng.choice([1, -2.5, None, True])
        many = [value(depth - 1) for _ in range(rng.randint(0, 4))]
        return many if kind == 2 else {f"k{i}\"": v for i, v in enumerate(many)}

    document = [value(3) for _ in range(40)]
    content = json.dumps(document, ensure_ascii=False, indent=seed % 3 or None).encode()
    for _ in range(30):
        cuts = sorted(rng.sample(range(1, len(content)), min(len(content) - 1, rng.randint(0, 60))))
        parts = [content[a:b] for a, b in zip([0, *cuts], [*cuts, len(content)])]
        assert [json.loads(e) for e in _elements(_cut(content, parts))] == document


def test_documents_that_are_no_array(spark):
    bodies = {
        "array": ' [1, {"a": "x,]"}] ', "empty": "[ ]", "object": '{"a": [1, 2]}', "two": "[1] [2]", "early": '[1, "x', "text": "no",
        "nothing": "",
    }
    size = 3
    table = [
        (key, i, body.encode()[i * size : (i + 1) * size])
        for key, body in bodies.items()
        for i in range(max(1, -(-len(body) // size)))
    ]
    parts = spark.createDataFrame(table, "key string, part bigint, content binary")
    found = J.array_elements(parts, lambda row: bytes(row["content"])).collect()
    errors = {r.key for r in found if r.error}
    assert errors == {"object", "two", "early", "text"}
    assert sorted(r.element for r in found if r.key == "array") == ["1", '{"a": "x,]"}']
    assert not [r for r in found if r.key in ("empty", "nothing")]
    assert rows(J.array_elements(parts.limit(0), lambda row: b"")) == []


def test_no_task_has_all_parts_of_a_document(spark, monkeypatch):
    """Functions and open pieces are dealt by blocks of parts, and blocks of any number give the same elements."""
    monkeypatch.setattr(J, "BLOCK", 4)
    documents = {
        "many": [{"n": i, "text": 'a "quoted\\" [,' * (i % 5)} for i in range(60)],
        "long": ["x" * 300, "], [", ["y" * 200, 1], None],
        "one": [1],
    }
    size, table = 16, []
    for key, document in documents.items():
        content = json.dumps(document).encode()
        table += [(key, i, content[i * size : (i + 1) * size]) for i in range(-(-len(content) // size))]
    parts = spark.createDataFrame(table, "key string, part bigint, content binary")
    found = J.array_elements(parts, lambda row: bytes(row["content"])).collect()
    assert not [r for r in found if r.error]
    for key, document in documents.items():
        got = [json.loads(r.element) for r in found if r.key == key]
        assert sorted(map(repr, got)) == sorted(map(repr, document))

    functions = [(k, p, *map(list, zip(*J.part_function(c)))) for k, p, c in table]
    starts = J.part_begins(spark.createDataFrame(functions, J.FUNCTIONS))
    expected = []
    for key in documents:
        state, depth = J.OUTSIDE, 0
        for _, part, content in (t for t in table if t[0] == key):
            expected.append((key, part, state, depth))
            after, change = J.part_function(content)[state]
            state, depth = after, depth + change
    assert rows(starts) == sorted(expected, key=repr)
    pieces = J.element_numbers(spark.createDataFrame([("d", 0, 0, J.TAIL, b"")], J.PIECES))
    for dealt, block in ((starts, "block"), (pieces, "_block")):
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(key#\d+, {block}#\d+", plan)


def test_the_array_file_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    """The one task that writes the query's file passes the lines on; it does not sort them."""
    from lake_ingest.checks import pipelines
    from tests.conftest import SF_DIR

    written = []
    kind = type(spark.range(0).write)
    monkeypatch.setattr(kind, "text", lambda self, path, text=kind.text: (written.append(self._df), text(self, path))[1])
    assert pipelines.json_array_parts(spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    assert len(written) == 1
    assert "Sort " not in written[0]._jdf.queryExecution().executedPlan().toString()
