"""A full run from files on disk to exported files, as the README shows it."""

import json

from signalloom.operators import alerts
from signalloom.plans.runs import Run
from signalloom.sources import base, tables


def test_full_run_from_files(spark, tmp_path):
    jobs = [{"title": f"Role {i}", "content": "We offer catered lunch", "updated_at": "2026-04-28",
             "absolute_url": f"https://boards.greenhouse.io/acme/jobs/{i}",
             "location": {"name": "Chicago" if i < 5 else "Boston"}} for i in range(8)]
    (tmp_path / "gh").mkdir()
    (tmp_path / "gh" / "a.json").write_text("\n".join(json.dumps(r) for r in (
        {"slug": "acme", "payload": json.dumps({"jobs": jobs})}, {"slug": "x", "payload": "?"})))
    (tmp_path / "m.csv").write_text(
        "Account Name,Company Domain Name,ezCater Vertical,Billing City\n"
        "Acme Inc,acme.com,Technology,Boston\n")
    (tmp_path / "u.csv").write_text("Account Name,Domain\nBeta,beta.com\n")
    (tmp_path / "t.csv").write_text("market,rep_name,slack_handle,webhook_env_var\n"
                                    "Boston,Old,,A\nBoston,Kim,,SLACK_B\nOther,Unassigned,,X\n")
    run = Run(spark, f"{tmp_path}/state", "2026-05-01", "2026-05-01",
              tables.read_accounts(spark, f"{tmp_path}/m.csv", f"{tmp_path}/u.csv"),
              territories=alerts.territories(tables.read_territories(spark, f"{tmp_path}/t.csv")),
              channels=["SLACK_B"])
    out = run.full({"gh": {"landed": base.read_landed(spark, f"{tmp_path}/gh")}})
    company = out["companies"].first()
    # 7 keyword + 2 count + 2 source, managed 15, Chicago confirmed expansion 15,
    # Boston possible existing 5
    assert company.gtm_score == 11 + 15 + 15 + 5 and company.segment == "managed"
    assert (company.expansion_confirmed, company.existing_possible) == ("Chicago", "Boston")
    assert company.market == "Boston" and company.sample_title == "Role 0"
    alert = out["alerts"].first()
    assert (alert.channel_key, alert.market, alert.n) == ("SLACK_B", "Boston", 1)
    payload = json.loads(alert.payload_json)
    assert payload["blocks"][1]["elements"][0]["text"].startswith("@Kim ")
    run.export(out, f"{tmp_path}/out")
    back = tables.read_jobs(spark, f"{tmp_path}/out/jobs_csv")
    assert back.count() == 8
    stats = json.loads(spark.read.text(f"{tmp_path}/out/dashboard/stats").first()[0])
    assert stats["total_companies"] == 1 and stats["last_run_new"] == 1


def test_registered_full_run_verifies_every_posting(spark, sf, monkeypatch):
    from signalloom.bindings import runs
    seen = {}

    def finish(self, jobs, crawl=None):
        seen.update(jobs=jobs, crawl=crawl)
        return {"companies": None}
    monkeypatch.setattr(Run, "finish", finish)
    runs.full_run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert seen["jobs"].join(seen["crawl"], "url", "left_anti").count() == 0
    assert seen["crawl"].select("body").exceptAll(docs.select("text")).count() == 0
    assert seen["crawl"].count() == docs.count()
