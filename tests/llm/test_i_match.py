"""I-Match against plain Python, SQL, and in both forms of its lexicon."""

import hashlib
import re

from tests.compare import database, difference
from winback.llm import i_match, queries
from winback.llm.i_match import DIGITS, FAMILIES, HALVINGS
from winback.llm.rows import with_row_key

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return set(WORD.findall((text or "").translate(CAPITALS)))


def digest(chosen):
    held = " ".join(sorted(chosen, key=lambda w: w.encode())).encode()
    return hashlib.md5(held).hexdigest()[:DIGITS]


def plain_fingerprint(text, lexicon):
    mine = words(text)
    inside = mine & lexicon
    out = [digest(inside or mine)]
    for family in range(FAMILIES):
        draw = {w: int(hashlib.sha256(w.encode()).hexdigest()[4 * family : 4 * family + 4], 16) for w in inside}
        out += [digest({w for w in inside if draw[w] < 65536 >> h}) for h in HALVINGS]
    return out


def plain_likeness(a, b):
    nothing = digest([])
    pairs = [(x, y) for x, y in zip(a, b, strict=True) if (x, y) != (nothing, nothing)]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0


def plain(rows, most, least):
    sets = [words(t) for _, t in rows]
    df = {w: sum(w in s for s in sets) for w in set().union(*sets)}
    lexicon = {w for w, n in df.items() if n * most <= len(rows) <= n * least}
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for place, (i, text) in enumerate(rows):
        text, after = text or "", rows[(place + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, other = (plain_fingerprint(t, lexicon) for t in (text, edited, after))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        near = (plain_likeness(own, changed), plain_likeness(own, other))
        out[i] = (len(text), sha, "".join(own), "".join(changed), *near)
    return out


def test_equals_plain_python(spark, messy, frame):
    # One row per id: the order of equal ids is the operator's own.
    rows = list({i: (i, t) for i, t in messy if i is not None}.values())
    want = plain(rows, 3, 20)
    for held in (i_match.HELD, 0):
        found = i_match.against_edits(frame(rows), most=3, least=20, held=held).collect()
        assert {r.doc_id: tuple(r)[1:] for r in found} == want
        assert len(found) == len(rows)


def test_every_row_keeps_its_own(spark, messy, frame):
    found = i_match.against_edits(frame(messy), most=3, least=20).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in messy)
    by_text = {}
    for i, t in messy:
        if i is not None and sum(j == i for j, _ in messy) == 1:
            by_text.setdefault(t or "", set()).add(next(r.fingerprint for r in found if r.doc_id == i))
    assert all(len(prints) == 1 for prints in by_text.values())


def test_small_tables(spark):
    schema = "doc_id long, text string"
    assert i_match.against_edits(spark.createDataFrame([], schema)).collect() == []
    (one,) = i_match.against_edits(spark.createDataFrame([(1, "abcd ef")], schema)).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcdabc").hexdigest()
    assert one.near_next == 1.0 and one.near_edited < 1.0


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.op11_i_match(spark, folder)
    assert difference(database(folder), found, queries.SQL["op11_i_match"]) is None


def test_edits_are_nearer_than_other_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op11_i_match(spark, folder).collect()
    assert sum(r.near_edited > r.near_next for r in found) > 0.8 * len(found)
    assert sum(r.near_next for r in found) < 0.01 * len(found)


def test_lexicon_is_no_column_of_the_plan(spark):
    """Rows would carry the whole lexicon if the optimiser did not merge the two steps."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    band = i_match.lexicon(docs)
    keyed = with_row_key(docs)
    found = i_match.with_fingerprint(keyed.frame, keyed.key, "text", band, "fingerprint")
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    for frame in (found, i_match.against_edits(docs)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "AS table#" not in plan and "scalar-subquery" in plan
        assert "Python" not in plan and "Arrow" not in plan
