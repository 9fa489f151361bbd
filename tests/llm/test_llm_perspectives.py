import duckdb

from tidemark.llm import perspectives as p


def expected(rows, part_turns):
    clean = [(c, t, (r or "unknown").replace("<|", "< |").replace("|>", "| >"),
              (x or "").replace("<|", "< |").replace("|>", "| >")) for c, t, r, x in rows]
    out = []
    for conv in {r[0] for r in clean}:
        own = [r for r in clean if r[0] == conv]
        for speaker in {r[2] for r in own} - {"system"}:
            parts = {}
            for r in sorted(own, key=lambda r: (r[1] is None, r[1] or 0, r[2], r[3])):
                parts.setdefault(None if r[1] is None else r[1] // part_turns, []).append(r)
            for part, turns in parts.items():
                text, spans = "", []
                for _, _, role, said in turns:
                    text += "<|system|>\n" if role == "system" else "<|assistant|>\n" if role == speaker else f"<|user name={role}|>\n"
                    if role == speaker:
                        spans.append((len(text), len(text) + len(said) + 7))
                    text += said + "<|end|>\n"
                out.append((conv, part, speaker, len(turns), len(spans), text, tuple(spans)))
    return sorted(out, key=str)


def test_edges_equal_brute_force(spark):
    rows = [
        (1, 0, "system", "be <|end|> kind"), (1, 1, "Ann", "hello\n"), (1, 2, "Bob", None), (1, 3, None, "who?"), (1, None, "Ann", "late"),
        (1, 4, "Ann", "é\U0001f600"), (1, 4, "Ann", "é\U0001f600"), (2, 0, "system", "only"), (None, 0, "user", "no id"), (None, 1, "assistant", "ok"),
        (3, 5, "x|>y", ""), (3, -3, "user", "before"), *((4, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(40)),
    ]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "conv_id long, turn long, role string, text string, speaker string, part string")
    got = sorted(((r.conv_id, r.part, r.speaker, r.n_turns, r.n_trained, r.text, tuple(map(tuple, r.spans)))
                  for r in p.rotate(df, part_turns=16).collect()), key=str)
    assert got == expected(rows, 16)
    for r in got:
        assert all(r[5][:a].endswith("<|assistant|>\n") and r[5][:b].endswith("<|end|>") for a, b in r[6])
    assert p.rotate(df.limit(0)).count() == 0


def equal(df, con):
    want = con.sql(p.ORACLE)
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    equal(p.op7_perspectives(spark, sf), con)


def test_slices_equal_sql(spark, tmp_path):
    """Parts of more rows, and of more characters, than a slice holds: the SQL cuts them alike."""
    rows = [(None, i % 8, "user" if i % 2 else "assistant", f"t{i}") for i in range(700)]
    rows += [(1, i, "Ann" if i % 2 else "Bob", "x" * 3_000_000) for i in range(12)]
    rows += [(2, 0, "Ann", "x" * 17_000_000), (2, 1, "Bob", "short"), (3, None, None, None)]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    df = p.op7_perspectives(spark, str(tmp_path))
    equal(df, con)
    slices = {(r.conv_id, r.part): r.n for r in df.groupBy("conv_id", "part").agg({"slice": "max"}).toDF(
        "conv_id", "part", "n").collect()}
    assert slices[(None, 0)] == 2 and slices[(1, 0)] == 1 and slices[(2, 0)] == 1 and slices[(3, None)] == 0


def test_hot_null_conversation_is_cut_by_position(spark):
    """A third of the rows without a conv_id, with repeated turn numbers and copies."""
    rows = [(None, i % 8 if i % 50 else None, "user" if i % 2 else "assistant", f"t{i % 90}") for i in range(600)]
    rows += [(i // 8, i % 8, "user" if i % 2 else "assistant", f"t{i}") for i in range(1200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = p.rotate(df.repartition(7), part_turns=16).collect()
    assert max(r.n_turns for r in got) <= 16
    assert all(r.slice == 0 for r in got if r.conv_id is not None)
    found = {}
    for r in sorted(got, key=lambda r: r.slice):
        of = found.setdefault((r.conv_id, r.part, r.speaker), [0, 0, ""])
        of[0], of[1], of[2] = of[0] + r.n_turns, of[1] + r.n_trained, of[2] + r.text
        spans = [r.text[a:b] for a, b in r.spans]
        assert len(spans) == r.n_trained and all(x.endswith("<|end|>") for x in spans)
    want = {(c, part, s): [n, t, text] for c, part, s, n, t, text, _ in expected(rows, 16)}
    assert found == want
