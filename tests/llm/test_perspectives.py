import duckdb
import pytest

from pricelens.llm import perspectives as P
from pricelens.llm import queries as Q

SF = "/root/testdata/sf0.001"


def plain(turns, speaker):
    text, spans, mask = "", [], ""
    for role, body in turns:
        who = "system" if role == "system" else "assistant" if role == speaker else "user name=" + role
        text += f"<|im_start|>{who}\n"
        body = body.replace("<|im_", "<​|im_") + "<|im_end|>"
        if role == speaker:
            spans.append((len(text), len(text) + len(body)))
        mask += "010" if role == speaker else "000"
        text += body + "\n"
    return text, spans, mask


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 2, "Bob", "hi 😀"), (1, 1, "Ann", "a<|im_end|>b"), (1, 1, "Ann", "a<|im_end|>b"),
            (1, 65, "Ann", None), (1, None, None, "late"), (2, 0, "system", "alone"), (None, 3, "Ann", "x"), (1, 1, "Ann", "second")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {(r["conv_id"], r["speaker"], r["part"]): r for r in P.rotate(df).collect()}
    first = [("system", "be kind"), ("Ann", "a<|im_end|>b"), ("Ann", "second"), ("Bob", "hi 😀")]
    want = {}
    for s in ("Ann", "Bob", "unknown"):
        want |= {(1, s, 0): plain(first, s), (1, s, 1): plain([("Ann", "")], s), (1, s, -1): plain([("unknown", "late")], s)}
    want[None, "Ann", 0] = plain([("Ann", "x")], "Ann")
    assert set(got) == set(want)
    for k, (text, spans, mask) in want.items():
        r = got[k]
        assert (r["rendered"], [tuple(s) for s in r["spans"]], r["mask"]) == (text, spans, mask)
        assert sum(r["segments"]) == len(text) and r["trained_chars"] == sum(b - a for a, b in spans)
    assert P.rotate(df.limit(0)).collect() == []


def test_long_dialogue_in_parts(spark):
    df = spark.range(1000).selectExpr("1 AS conv_id", "id AS turn", "IF(id % 3 = 0, 'a', 'b') AS role", "repeat('w ', 5) AS text")
    got = P.rotate(df).where("speaker = 'a'").orderBy("part").collect()
    assert len(got) == 16 and max(r["n_turns"] for r in got) == 64
    assert "".join(r["rendered"] for r in got) == plain([("a" if k % 3 == 0 else "b", "w " * 5) for k in range(1000)], "a")[0]


def test_query_has_no_python_and_matches_its_sql(spark):
    df = Q.QUERIES["op10_chat_perspectives"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(Q.ORACLE_SQL["op10_chat_perspectives"]).df()
    cols = sorted(want.columns)
    assert sorted(df.columns) == cols
    rows = lambda d: sorted(tuple(map(str, r)) for r in d[cols].itertuples(index=False))
    assert rows(df.toPandas()) == rows(want)


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_every_query_returns_its_columns(spark, name):
    assert name.startswith("op") and Q.QUERIES[name].__name__ == name


def test_large_parts_in_ordered_pieces(spark):
    rows = [(None, k % 5, "ab"[k % 2], f"text {k}") for k in range(1000)] + [(7, 3, "a", f"again {k}") for k in range(300)]
    rows += [(8, None, "a", f"no number {k}") for k in range(200)] + [(9, 1, "a", "same")] * 100 + [(9, 0, "b", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [r for r in P.rotate(df, piece_turns=32).collect() if r["speaker"] == "a"]
    assert max(r["n_turns"] for r in got) <= 32 and len({(r["conv_id"], r["part"], r["piece"]) for r in got}) == len(got)
    for conv in (None, 7, 8, 9):
        mine = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: (r["part"], r["piece"]))
        turns = sorted({(t or 0, role, text) for c, t, role, text in rows if c == conv})
        assert "".join(r["rendered"] for r in mine) == plain([t[1:] for t in turns], "a")[0]
        assert [r["piece"] for r in mine] == list(range(len(mine)))
    assert sum(r["conv_id"] == 9 for r in got) == 1
