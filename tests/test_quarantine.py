from tessera.operators import quarantine as QR

HEADER = "a,b ,c"
LINES = {
    '1,2,3': None, '"x,y",2,3': None, '"he said ""no""",2,3': None, '"esc \\" quote, in",2,3': None, ',,': None, '5" pipe,2,3': None,
    '"",2,3': None, '1,2': "too few fields", '1': "too few fields", '1,2,3,4': "too many fields", '1,2,3,': "too many fields",
    '1,"2,3': "broken quote", '1,"2"x,3': "broken quote", '"1,2,3': "broken quote", '1,2,"': "broken quote",
}


def _write(folder, *files):
    folder.mkdir()
    for i, lines in enumerate(files):
        (folder / f"{i}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_every_record_is_parsed_or_kept_with_its_reason(spark, tmp_path):
    path = _write(tmp_path / "f", [HEADER, *LINES, "", "  "], [HEADER, "1,2,3", "1,2"], [HEADER])
    good, bad = QR.split_records(spark, path)
    told = {r.line: r.reason for r in bad.collect()}
    assert told == {k: v for k, v in LINES.items() if v}
    assert good.count() + bad.count() == len(LINES) + 2
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"0.csv", "1.csv"}
    # parsed as Spark parses files without the malformed lines
    fine = [k for k, v in LINES.items() if not v] + ["1,2,3"]
    escaped = _write(tmp_path / "g", [HEADER, *[k for k in fine if '\\"' in k]])
    doubled = _write(tmp_path / "k", [HEADER, *[k for k in fine if '\\"' not in k]])
    read = spark.read.option("header", "true")
    plain = read.csv(escaped).collect() + read.option("escape", '"').csv(doubled).collect()
    key = lambda rows: sorted(map(repr, map(tuple, rows)))
    assert good.columns == read.csv(escaped).columns and key(good.collect()) == key(plain)
    assert ('he said "no"', "2", "3") in map(tuple, good.collect())


def test_a_file_of_malformed_lines_and_an_empty_one(spark, tmp_path):
    good, bad = QR.split_records(spark, _write(tmp_path / "h", [HEADER, "1", "1,2,3,4"]))
    assert good.count() == 0 and bad.count() == 2
    good, bad = QR.split_records(spark, _write(tmp_path / "i", [HEADER]))
    assert good.count() == 0 and bad.count() == 0


def test_a_long_field(spark, tmp_path):
    long = '"' + 'x""y,' * 50_000 + '"'
    good, bad = QR.split_records(spark, _write(tmp_path / "j", [HEADER, f"{long},2,3", f"{long},2"]))
    assert good.count() == 1 and [r.reason for r in bad.collect()] == ["too few fields"]


def test_each_line_is_parsed_once(spark, tmp_path):
    """Every use of a parsed column must not parse the line again."""
    path = _write(tmp_path / "k", [",".join(f"h{i}" for i in range(20)), ",".join("v" * 20)])
    for df in QR.split_records(spark, path):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_csv(") == 2 and plan.count("regexp_replace(") == 1      # one branch of two runs in a line
