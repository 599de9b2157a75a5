"""The gate over files that arrive in two runs."""

from collections import Counter

from furrow.streaming.arrivals import arriving, gate_arrivals

HEAD = "year,country,avg_temp\n"


def test_arrivals_are_gated_once_and_copies_across_runs_are_caught(spark, tmp_path):
    incoming, home = tmp_path / "incoming", str(tmp_path / "home")
    incoming.mkdir()

    def run():
        query = gate_arrivals(arriving(spark, str(incoming), "temp"), "temp", home)
        query.awaitTermination()

    (incoming / "a.csv").write_text(HEAD + "2000,Kenya,20\n2000,Kenya,20\n2000,Kenya,500\n2001,Kenya,\n")
    run()
    assert spark.read.parquet(f"{home}/accepted/temp").count() == 2
    (incoming / "b.csv").write_text(HEAD + "2000,Kenya,20\n2001,Kenya,\n2002,Kenya,21\n")
    run()
    run()  # nothing new
    accepted = sorted((r["year"], r["avg_temp"]) for r in spark.read.parquet(f"{home}/accepted/temp").collect())
    assert accepted == [("2000", "20"), ("2001", None), ("2002", "21")]
    reasons = Counter(r["reject_reason"] for r in spark.read.parquet(f"{home}/quarantine/temp").collect())
    assert reasons == {"duplicate_row": 3, "implausible_temp": 1}
