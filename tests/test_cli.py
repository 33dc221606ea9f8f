import json

from tidemark.__main__ import main


def test_cli_ingest_index_search(spark, customers, cases, tmp_path, capsys):
    customers.write.parquet(str(tmp_path / "src_customers"))
    cases.write.parquet(str(tmp_path / "src_cases"))
    tables = ["--table", f"customers:customer_id:updated_at:{tmp_path}/src_customers",
              "--table", f"cases:case_id:updated_at:{tmp_path}/src_cases"]
    dirs = ["--lake", str(tmp_path / "lake"), "--state", str(tmp_path / "st"),
            "--events", str(tmp_path / "ev")]
    assert main(["ingest", *dirs, *tables, "--dry-run"]) == 0
    dry = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert dry["dry_run"] and dry["tables"]["cases"]["delta_row_count"] == 5
    assert main(["ingest", *dirs, *tables]) == 0
    real = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert real["tables"]["cases"]["checkpoint_after"] == "2024-01-06T00:00:00+00:00"
    assert main(["index", "--lake", str(tmp_path / "lake"), "--table", tables[3],
                 "--text", "title,description", "--payload", "title,status",
                 "--out", str(tmp_path / "idx")]) == 0
    capsys.readouterr()
    assert main(["search", "--index", str(tmp_path / "idx"), "--payload", "title,status",
                 "--query", "storm lamp", "--top-k", "2"]) == 0
    hits = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert hits[0]["case_id"] == 2 and hits[0]["title"] == "Storm signal lamp"
    assert len(hits) <= 2


def test_cli_columns_events_and_quarantine(spark, cases, tmp_path, capsys):
    cases.write.parquet(str(tmp_path / "src"))
    table = ["--table", f"cases:case_id:updated_at:{tmp_path}/src",
             "--columns", "cases=case_id,title,updated_at"]
    lake = ["--lake", str(tmp_path / "lake")]
    assert main(["ingest", *lake, "--state", str(tmp_path / "st"), "--events",
                 str(tmp_path / "ev"), *table]) == 0
    event, manifest = map(json.loads, capsys.readouterr().out.strip().splitlines()[-2:])
    assert event["table"] == "cases" and event["delta_row_count"] == 5
    assert manifest["tables"]["cases"]["schema_fingerprint"] == event["schema_fingerprint"]
    stored = spark.read.json(str(tmp_path / "lake" / "cases"))
    assert sorted(stored.columns) == ["case_id", "date", "title", "updated_at"]
    (tmp_path / "lake" / "cases" / "date=2024-01-02" / "part-x.json").write_text('{"case_id": 9, "ti')
    assert main(["index", *lake, *table, "--text", "title", "--out", str(tmp_path / "idx")]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["quarantined"] == 1
