import hashlib

from faultline.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string, h string, t string, keep_id int, m map<string,int>"
ROWS = [
    (1, "a", "x", "y", 0, None),
    (5, "a", "x", "y", 0, {"k": 1}),
    (3, "a", "x", "y", 0, None),
    (7, None, "", "", 0, None),
    (8, "", "", "", 0, None),
    (9, "A", "", "", 0, None),  # no normalisation
    (10, "a ", "", "", 0, None),
    (11, "long " * 50_000, "", "", 0, None),
    (12, "long " * 50_000, "", "", 0, None),
]


def _brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_marks_match_brute_force(spark):
    got = sorted((tuple(r) for r in ed.mark_copies(spark.createDataFrame(ROWS, SCHEMA)).collect()), key=repr)
    assert got == _brute(ROWS)


def test_drop_copies_keeps_whole_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = ed.drop_copies(df)
    assert kept.columns == df.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert sorted(rows) == [5, 8, 9, 10, 12]
    assert rows[5].m == {"k": 1} and rows[5].h == "x"


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a", "", "", 0, None)] * 3 + [(None, "b", "", "", 0, None)] * 2 + [(None, "a", "", "", 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = ed.mark_copies(df).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in got) == (
        [(0, 0, 2, True)] * 2 + [(0, 1, 4, False)] + [(1, 1, 4, True)] * 3
    )
    assert sorted((r.doc_id or 0, r.text) for r in ed.drop_copies(df).collect()) == [(0, "b"), (1, "a")]
    assert ed.mark_copies(df.limit(0)).count() == 0 and ed.drop_copies(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = ed.mark_copies(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
