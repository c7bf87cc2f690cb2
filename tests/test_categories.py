"""Categories as a table, and sparse vectors of flags from it, against plain loops."""

from creditloom.operators import categories


def plain(rows, columns):
    """Sorted values per column, and the set positions of each row."""
    values = [sorted({r[c] for r in rows} - {None}, key=lambda v: v.encode()) for c in columns]
    starts, start = [], 0
    for v in values:
        starts.append(start)
        start += max(0, len(v) - 1)

    def positions(row):
        codes = [(v.index(row[c]) if row[c] in v else -1) for v, c in zip(values, columns)]
        return sorted(s + code - 1 for s, code in zip(starts, codes) if code > 0)

    return values, positions, start


def test_against_plain_loops(spark, tmp_path):
    hot = ["hot"] * 900
    rows = [(i, h, f"w{i * 7 % 1500:04d}" if i % 11 else None, None, "é" if i % 3 else "z")
            for i, h in enumerate(hot + [f"c{i}" for i in range(900)])]
    rows += rows[:5] + [(None, "", "a.b", None, "z")]
    df = spark.createDataFrame(rows, "k long, `s.s` string, w string, void string, two string")
    columns = {"s.s": 1, "w": 2, "void": 3, "two": 4}
    found = categories.fit_categories(df, list(columns), str(tmp_path / "fit"))
    values, positions, width = plain(rows, columns.values())
    assert found.sizes == {c: len(v) for c, v in zip(columns, values)} and found.width() == width
    got = sorted((r.column_name, r.code, r.value) for r in found.table.collect())
    assert got == sorted((c, k, v) for c, vs in zip(columns, values) for k, v in enumerate(vs))
    again = categories.load_categories(spark, str(tmp_path / "fit"), list(columns))
    assert again.sizes == found.sizes
    out = categories.flag_vectors(df, again, str(tmp_path / "rows"))
    assert out.columns == ["k", "flags"]
    key = lambda t: (t[0] is None, t)
    assert sorted(((r.k, list(map(int, r.flags.indices))) for r in out.collect()), key=key) == sorted(
        ((r[0], positions(r)) for r in rows), key=key)
    assert {r.flags.size for r in out.collect()} == {width}


def test_many_categories_new_values_and_no_rows(spark, tmp_path):
    df = spark.range(100_000).selectExpr("id AS k", "concat('v', id) AS s")
    found = categories.fit_categories(df, ["s"], str(tmp_path / "fit"))
    assert found.sizes == {"s": 100_000}
    out = categories.flag_vectors(df, found, str(tmp_path / "rows"))
    assert out.count() == 100_000
    by_text = sorted(f"v{i}" for i in range(100_000))
    row = out.where("k = 77").first()
    assert list(row.flags.indices) == [by_text.index("v77") - 1] and row.flags.size == 99_999
    new = spark.createDataFrame([(1, "unseen"), (2, None), (3, "v0")], "k long, s string")
    assert all(r.flags.numNonzeros() == 0 for r in categories.flag_vectors(new, found, str(tmp_path / "new")).collect())
    none = categories.fit_categories(df.where("false"), ["s"], str(tmp_path / "none"))
    assert none.width() == 0 and categories.flag_vectors(df.where("false"), none, str(tmp_path / "empty")).count() == 0
