import datetime as dt

from cartwheel.__main__ import parser, run
from cartwheel.plans.layers import GROUPS
from cartwheel.sources.files import parquet
from cartwheel.sources.jdbc import Split
from test_clickstream import line


def test_arguments():
    args = parser().parse_args(
        ["gold", "--silver_path", "s", "--gold_path", "g", "--build_q1", "false", "--build_dims", "TRUE"]
    )
    assert [group for group in GROUPS if getattr(args, f"build_{group}")] == ["dims", "facts", "q2", "q3", "q4", "q5"]
    args = parser().parse_args(["silver", "--tables", "users, orders,", "--bronze_path", "b", "--silver_out", "s",
                                "--watermarks", "w"])
    assert args.tables == ["users", "orders"]
    args = parser().parse_args(["bronze", "--jdbc_url", "u", "--jdbc_user", "u", "--jdbc_password", "p", "--bronze_out",
                                "b", "--watermarks", "w", "--split", "orders=order_id,1,9000,16"])
    assert dict(args.split) == {"orders": Split("order_id", "1", "9000", 16)}


def test_transactions_job(spark, tmp_path, capsys):
    (tmp_path / "u.csv").write_text("user_id,region,name\n1,HN,A\n2,HCM,B\n")
    (tmp_path / "t.csv").write_text("transaction_id,user_id,amount\n1,1,10\n2,1,20\n3,2,5\n")
    for _ in range(2):
        run(spark, parser().parse_args(
            ["transactions", "--users", str(tmp_path / "u.csv"), "--transactions", str(tmp_path / "t.csv"),
             "--output", str(tmp_path / "out")]
        ))
    assert "rows: 2" in capsys.readouterr().out
    found = {(row.region, row.user_id, row.total_amount) for row in parquet(spark, str(tmp_path / "out")).collect()}
    assert found == {("HN", 1, 30), ("HCM", 2, 5)}
    assert (tmp_path / "out" / "region=HN").is_dir()


def test_clicks_then_silver(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(line(1) + line(1) + line(2))
    clicks = ["clickstream", "--bronze_out", str(tmp_path / "bronze"), "--checkpoint_path", str(tmp_path / "cp")]
    silver = ["silver", "--bronze_path", str(tmp_path / "bronze"), "--silver_out", str(tmp_path / "silver"),
              "--watermarks", str(tmp_path / "state")]
    for _ in range(2):
        run(spark, parser().parse_args([*clicks, "--input_path", str(landing)]))
        run(spark, parser().parse_args(silver))
    found = parquet(spark, str(tmp_path / "silver" / "clickstream"))
    assert sorted(row.event_id for row in found.collect()) == [1, 2]
    assert found.first().event_time == dt.datetime(2024, 1, 1, 10)


def test_one_click_file(spark, tmp_path):
    file = tmp_path / "clicks.csv"
    arguments = ["clickstream", "--bronze_out", str(tmp_path / "bronze"), "--checkpoint_path", str(tmp_path / "cp"),
                 "--input_path", str(file)]
    for text in (line(1), line(1) + line(2)):
        file.write_text(text)
        run(spark, parser().parse_args(arguments))
    found = parquet(spark, str(tmp_path / "bronze" / "clickstream"))
    assert sorted(row.event_id for row in found.collect()) == [1, 2]
