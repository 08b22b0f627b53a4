import json

from sluice.streaming import folds


def test_fold_carries_over_batches(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    parts = [
        [(1, 1, "accept", True, "x"), (2, 1, "accept", True, "y"), (3, 1, "block", False, None)],
        [(1, 2, "comment", False, None), (2, 2, "reset_review", False, None)],
        [(1, 3, "block", True, ""), (2, 3, "accept", False, None), (3, 0, "accept", True, "late")],
    ]
    seen = {}

    def handle(df, _):
        seen.update({r.key: (r.action, r.state, r.carried) for r in df.collect()})

    want = [{1: ("accept", "latest", "x"), 2: ("accept", "latest", "y"), 3: ("block", "latest", None)}, {1: ("comment", "latest", "x"), 2: ("reset_review", "reset", None)}, {1: ("block", "latest", None), 2: ("accept", "latest", None), 3: ("block", "latest", None)}]
    for i, rows in enumerate(parts):
        (source / f"{i}.json").write_text("\n".join(json.dumps(dict(zip(("key", "seq", "action", "has_correction", "correction"), r))) for r in rows))
        stream = spark.readStream.schema("key long, seq long, action string, has_correction boolean, correction string").json(str(source))
        folds.drain(folds.fold_stream(stream), handle, str(tmp_path / "state"), "update")
        for key, value in want[i].items():
            assert seen[key] == value
