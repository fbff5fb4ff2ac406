"""All four jobs from one job file, from quote CSV files to scored messages."""

import datetime as dt
import json

import pytest

from brute import QUOTE_SCHEMA, random_quotes
from quotegrid.__main__ import main
from quotegrid.jobconfig import JobConfig
from quotegrid.sources.quotes import write_quote_csv
from test_streaming import messages

STEP = 600_000_000_000


def test_jobs_from_files_to_messages(spark, tmp_path, capsys):
    yaml = pytest.importorskip("yaml")
    rows = random_quotes(21, ["AAA", "BBB"], 6, 50, STEP)
    rows = [(*r[:1], r[1] // 1000 * 1000, r[2] // 1000 * 1000, *r[3:]) for r in rows]
    from pyspark.sql import functions as F

    q = spark.createDataFrame(rows, QUOTE_SCHEMA).withColumn("exchange", F.lit("x"))
    first = dt.date(2022, 1, 8)
    for s in ("AAA", "BBB"):
        for k in range(6):
            day = first + dt.timedelta(days=k)
            part = q.where((F.col("symbol") == s) & (F.date_from_unix_date((F.col("local_ts_ns") / 86_400_000_000_000).cast("int")) == F.lit(day)))
            folder = tmp_path / "raw" / s / "book_ticker"
            folder.mkdir(parents=True, exist_ok=True)
            out = tmp_path / "csv" / f"{s}{k}"
            write_quote_csv(part.coalesce(1), str(out))
            import gzip

            texts = [gzip.open(f, "rt").read() for f in sorted(out.glob("*.csv.gz"))]
            body = texts[0].splitlines()[:1] + [l for t in texts for l in t.splitlines()[1:]]
            with gzip.open(folder / f"binance-futures_book_ticker_{day}_{s}.csv.gz", "wt") as f:
                f.write("\n".join(body) + "\n")
    (tmp_path / "assets.json").write_text(json.dumps({"future": {s: {"tick_size": 0.01, "lot_size": 1} for s in ("AAA", "BBB")}}))
    (tmp_path / "events").mkdir()
    (tmp_path / "events" / "0.json").write_text("\n".join(json.dumps(m) for m in messages([r for r in rows if r[2] >= r[1]])))
    conf = {
        "store": str(tmp_path / "store"),
        "assets": str(tmp_path / "assets.json"),
        "quote_files": {"primary": str(tmp_path / "raw")},
        "symbols": ["AAA", "BBB"],
        "first_day": first + dt.timedelta(days=4),
        "last_day": first + dt.timedelta(days=5),
        "grid": {"interval_ns": STEP},
        "features": {"vol_windows": [30, 60, 120], "label_window": 60},
        "train": {"train_days": 2, "val_days": 1, "test_days": 2, "max_iter": 2, "max_depth": 2, "min_instances": 2, "max_bins": 16},
        "live": {"events": str(tmp_path / "events"), "out": str(tmp_path / "out"), "checkpoint": str(tmp_path / "state"), "warmup_minutes": 60},
    }
    job = tmp_path / "job.yaml"
    job.write_text(yaml.safe_dump(conf | {"first_day": first, "last_day": first + dt.timedelta(days=5)}))
    assert main(["features", str(job)]) == 1  # the first day has no day before it
    assert capsys.readouterr().out.count("failed: ") == 2
    job.write_text(yaml.safe_dump(conf))
    assert main(["features", str(job)]) == 0
    assert main(["research", str(job)]) == 0
    assert main(["production", str(job), "--date", "2022-01-12"]) == 0
    assert "published 2" in capsys.readouterr().out
    assert main(["live", str(job), "--available-now"]) == 0
    sent = [json.loads(l) for f in (tmp_path / "out").rglob("*.txt") for l in f.read_text().splitlines()]
    by_day = {}
    for m in sent:
        by_day.setdefault(str(dt.datetime.fromtimestamp(m["timestamp"] / 1e9, dt.timezone.utc).date()), set()).add(m["status"])
    assert by_day["2022-01-09"] == {"no_model"} and by_day["2022-01-12"] == {"ok"}
    assert all(("volatility" in m) == (m["status"] == "ok") for m in sent)


def test_unknown_settings_are_refused():
    base = {"store": "s", "assets": "a", "symbols": ["x"], "first_day": dt.date(2024, 1, 1), "last_day": dt.date(2024, 1, 2)}
    assert JobConfig.parse(base).features.vol_windows == (1, 3, 5, 10, 15, 30, 60, 120)
    with pytest.raises(ValueError):
        JobConfig.parse(base | {"train": {"trees": 3}})
    with pytest.raises(ValueError):
        JobConfig.parse(base | {"features": {"vol_windows": [1, 2], "label_window": 5}})
