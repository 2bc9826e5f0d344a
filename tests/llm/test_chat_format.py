import duckdb

from finlattice.llm.chat_format import format_preferences
from finlattice.llm.sql import OP5


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    show = lambda t: f"<|{t[2]}|>\n{t[3]}<|end|>\n"
    out = set()
    for p in {c // 2 for c in convs}:
        a, b = sorted(convs.get(2 * p, [])), sorted(convs.get(2 * p + 1, []))
        n = 0
        while n < min(len(a), len(b)) and a[n][2:] == b[n][2:]:
            n += 1
        sides = []
        for turns in (a[n:], b[n:]):
            done, spans = "", []
            for t in turns:
                begin = len(done) + len(t[2]) + 5
                done += show(t)
                if t[2] == "assistant":
                    spans.append(f"{begin}:{len(done)}")
            sides += [done, ",".join(spans)]
        out.add((p, len(a), len(b), n, "".join(map(show, a[:n])), *sides))
    return out


ROWS = [(0, 0, "user", "hé😀"), (0, 1, "assistant", "x"), (1, 0, "user", "hé😀"), (1, 1, "assistant", "y"), (1, 2, "user", None), (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, None, "only"), (-1, 0, "user", "n"), (-2, 0, "user", "n"), (-2, 0, "user", "n"), (None, 1, "user", "z"), (6, None, "assistant", "t" * 200_000), (7, 0, "assistant", "t" * 200_000), (8, 3, "a", "b"), (8, 1, "assistant", ""), (9, 7, "assistant", "")]


def test_odd_rows_and_sql(spark):
    conv = spark.createDataFrame([(*r, "extra") for r in ROWS], "conv_id long, turn long, role string, text string, prompt string")
    got = {tuple(r) for r in format_preferences(conv).collect()}
    assert got == brute(ROWS)
    conversations = conv.toPandas()  # noqa: F841
    assert set(duckdb.sql(OP5).fetchall()) == got
    assert format_preferences(conv.limit(0)).count() == 0


def test_whole_table_without_python(spark):
    conv = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    out = format_preferences(conv)
    assert {tuple(r) for r in out.collect()} == brute([tuple(r) for r in conv.select("conv_id", "turn", "role", "text").collect()])
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
