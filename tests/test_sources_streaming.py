"""Raw batch files (header, quarantine, exact multi-line reader) and streaming restart/no-op."""
import os


from ordersight.operators import quality
from ordersight.sources import raw_files
from ordersight.streaming import jobs

HEADER = raw_files.HEADER


def write_bytes(path, data: bytes):
    with open(path, "wb") as fh:
        fh.write(data)


def batch_file(d, stamp, lines, header=HEADER, newline="\n"):
    write_bytes(os.path.join(d, f"orders_{stamp}.csv"), (newline.join([header, *lines]) + newline).encode())


def test_text_reader_positions_and_header(spark, tmp_dir):
    batch_file(tmp_dir, "20240501T120000Z_0001", ["A,2024-05-01T12:00:01Z,3,15,10,1",
                                                   "A,2024-05-01T12:00:02Z,3,15,10,1",
                                                   "", "B,2024-05-01T12:00:03Z,3,15,10,x"], newline="\r\n")
    batch_file(tmp_dir, "20240501T120000Z_0002", ["C,2024-05-01T12:00:01Z,3,15,10,1"], header="id,ts")
    write_bytes(os.path.join(tmp_dir, ".orders_20240501T120000Z_0003.csv.tmp"), b"junk")
    data, status = raw_files.read_raw_files(spark, tmp_dir)
    st = {r.batch: r.skip_reason for r in status.collect()}
    assert st == {"20240501T120000Z_0001": None, "20240501T120000Z_0002": "unexpected header"}
    ann = quality.annotate(data).orderBy("pos").collect()
    assert [r.reason for r in ann] == [None, "duplicate_id", "bad_label"]
    assert ann[0].raw_line == "A,2024-05-01T12:00:01Z,3,15,10,1"          # CR stripped, text verbatim


def test_file_quarantine(spark, tmp_dir):
    good = (HEADER + "\nA,2024-05-01T12:00:01Z,3,15,10,1\n").encode()
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0001.csv", good)
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0002.csv", b"\xef\xbb\xbf" + good)
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0003.csv", good.replace(b"A,", b"\xe9,"))
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0004.csv", good.replace(b"A,", b"A\x00,"))
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0005.csv", b"")
    write_bytes(f"{tmp_dir}/orders_20241301T120000Z_0006.csv", good)
    got = {r.file[-8:-4]: r.reason for r in raw_files.file_quarantine(spark, tmp_dir).collect()}
    assert got == {"0001": None, "0002": "unexpected header", "0003": "not UTF-8 text",
                   "0004": "malformed CSV (NUL byte)", "0005": "empty file", "0006": "impossible batch stamp"}


def test_exact_reader_keeps_multiline_record(spark, tmp_dir):
    batch_file(tmp_dir, "20240501T120000Z_0001", ['A,2024-05-01T12:00:01Z,3,15,"10\nmore",1', "",
                                                   "B,2024-05-01T12:00:02Z,3,15,10,1"])
    assert raw_files.needs_exact_reader(spark, tmp_dir).first().multiline
    recs = raw_files.read_exact(spark, tmp_dir).orderBy("pos").collect()
    assert [r.raw_line for r in recs] == ['A,2024-05-01T12:00:01Z,3,15,"10\nmore",1', "B,2024-05-01T12:00:02Z,3,15,10,1"]
    ann = quality.annotate(raw_files.read_exact(spark, tmp_dir)).orderBy("pos").collect()
    assert [r.reason for r in ann] == ["not_a_number", None]


def to_raw(batch_df):
    return raw_files.usable_records(batch_df)


def test_clean_stream_restart_is_noop_and_picks_up_new_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    batch_file(str(raw), "20240501T120000Z_0001", ["A,2024-05-01T12:00:01Z,3,15,10,1", "A,2024-05-01T12:00:02Z,3,15,10,1"])
    batch_file(str(raw), "20240501T120100Z_0002", [])                    # header only: no rows
    batch_file(str(raw), "20240501T120150Z_0004", ["D,2024-05-01T12:01:51Z,3,15,10,1"], header="x,y")
    jobs.clean_stream(raw_files.raw_text_stream(spark, str(raw)), to_raw, out, ck).awaitTermination()
    o = jobs.stream_outputs(spark, out)
    assert o["features"].count() == 1 and o["rejects"].count() == 1
    jobs.clean_stream(raw_files.raw_text_stream(spark, str(raw)), to_raw, out, ck).awaitTermination()
    assert jobs.stream_outputs(spark, out)["features"].count() == 1          # second run: no-op
    batch_file(str(raw), "20240501T120200Z_0003", ["C,2024-05-01T12:02:01Z,3,15,10,0"])
    jobs.clean_stream(raw_files.raw_text_stream(spark, str(raw)), to_raw, out, ck).awaitTermination()
    o = jobs.stream_outputs(spark, out)
    assert sorted(r.order_id for r in o["features"].collect()) == ["A", "C"]
    led = {r.batch: (r.status, r.skip_reason) for r in o["ledger"].collect()}
    assert led == {"20240501T120000Z_0001": ("committed", None), "20240501T120200Z_0003": ("committed", None),
                   "20240501T120100Z_0002": ("committed", None),
                   "20240501T120150Z_0004": ("skipped", "unexpected header")}
    summary = jobs.stop_summary(spark, out).first()
    assert (summary.files, summary.kept, summary.rejected, summary.skipped) == (3, 2, 1, 1)


def test_retrain_stream_publishes_on_trigger_only(spark, tmp_path):
    import random
    from ordersight.operators import registry
    from ordersight.options import TrainOptions
    rng = random.Random(5)
    raw = tmp_path / "raw"
    raw.mkdir()
    out, models = str(tmp_path / "out"), str(tmp_path / "models")
    def add_batch(i, n=40):
        lines = []
        for j in range(n):
            d, p = round(rng.uniform(0.5, 12), 1), rng.randint(5, 30)
            late = int(p + 3 * d + rng.gauss(0, 4) > 30)
            lines.append(f"O{i}-{j},2024-05-01T{10 + i:02d}:{j:02d}:00Z,{d},{p},20.00,{late}")
        batch_file(str(raw), f"20240501T{10 + i:02d}0000Z_0001", lines)
    opts = TrainOptions(retrain_every=100)

    def run_all():
        jobs.clean_stream(raw_files.raw_text_stream(spark, str(raw)), to_raw, out, str(tmp_path / "ck")).awaitTermination()
        led = spark.read.parquet(f"{out}/ledger")
        feats = lambda: jobs.stream_outputs(spark, out)["features"]
        jobs.retrain_stream(spark.readStream.schema(led.schema).parquet(f"{out}/ledger"), f"{out}/ledger", feats,
                            models, str(tmp_path / "ck_train"), opts).awaitTermination()
        return {r.version: r.rows_total for r in registry.read_sidecars(spark, models).where("readable").collect()}

    add_batch(0)
    add_batch(1)
    assert run_all() == {}                          # 80 rows: below the trigger
    add_batch(2)
    assert run_all() == {1: 120}                    # 120 >= 100: version 1
    add_batch(3)
    assert run_all() == {1: 120}                    # 40 new rows: no retrain
    add_batch(4)
    add_batch(5)
    assert run_all() == {1: 120, 2: 240}
    coefs, _, why = registry.load_checkpoint(spark, models, 2, ["distance_km", "prep_minutes"])
    assert why is None and coefs["distance_km"] > 0 and coefs["prep_minutes"] > 0


def test_retrain_stream_outlives_failures(spark, tmp_path):
    """ST-02/ML-05: a failing read, fit or publish is a row, the query goes on, an unchanged state is not tried again."""
    from ordersight.operators import registry
    from ordersight.options import TrainOptions
    led, models = str(tmp_path / "led"), str(tmp_path / "models")
    calls = []

    def rows(n, label):
        return spark.range(n).selectExpr("cast(id div 10 as string) batch", "id pos", "id % 11 + 0.5D distance_km", "cast(id % 26 + 5 as int) prep_minutes",
                                         f"cast({label} as int) was_late", "timestamp_seconds(id) timestamp")

    def run(kept, reader):
        def features():
            calls.append(kept)
            return reader()
        if kept:
            spark.createDataFrame([("b", "committed", kept)], "batch string, status string, kept long").write.mode("append").parquet(led)
        stream = spark.readStream.schema("batch string, status string, kept long").parquet(led)
        jobs.retrain_stream(stream, led, features, models, str(tmp_path / "ck"), TrainOptions(retrain_every=100)).awaitTermination()
        return [(r.rows_available, r.top_version, r.status) for r in jobs.retrain_attempts(spark, models).orderBy("epoch").collect()]

    def broken():
        raise OSError("no such table")

    assert run(100, broken) == [(100, 0, "error")]
    spark.createDataFrame([("skip", "skipped", 0)], "batch string, status string, kept long").write.mode("append").parquet(led)
    assert run(0, broken) == [(100, 0, "error")] and calls == [100]          # a new epoch, the same state
    assert run(20, lambda: rows(120, "0")) == [(100, 0, "error"), (120, 0, "one_class_in_train")]
    registry.write_artifact(spark, f"{models}/model_v0001", training_result())   # half published: its number stays taken
    got = run(10, lambda: rows(130, "id % 3 = 0"))
    assert got[2:] == [(130, 1, "published")]
    assert [r.version for r in registry.read_sidecars(spark, models).where("readable").collect()] == [2]
    errors = [r.detail for r in jobs.retrain_attempts(spark, models).where("status = 'error'").collect()]
    assert errors == ["OSError: no such table"]


def training_result():
    from ordersight.operators.training import FitResult
    return FitResult({"distance_km": 0.6, "prep_minutes": 0.25}, -7.0, 99, 5)


def test_score_stream_hot_swap_never_rescores(spark, tmp_path):
    """ST-03/ML-09/ML-11: each batch is scored once, by the model that was newest at its boundary."""
    from ordersight.operators import registry
    from ordersight.operators.training import FitResult
    models, out = str(tmp_path / "models"), str(tmp_path / "out")
    m1 = FitResult({"distance_km": 0.6, "prep_minutes": 0.25}, -7.0, 99, 5)
    m2 = FitResult({"distance_km": 0.7, "prep_minutes": 0.35}, -9.0, 99, 5)
    side = {"rows_total": 10, "feature_columns": ["distance_km", "prep_minutes"]}
    from ordersight.streaming import committed
    epochs = iter(range(10))

    def add(batch):
        _clean(spark, out, next(epochs), batch, [f"{batch}-{i}" for i in range(3)])

    chooser = registry.ModelChooser(spark, models)

    def run():
        committed.score_stream(spark, out, chooser, str(tmp_path / "ck")).awaitTermination()
        return {r.batch: r.checkpoint_id for r in committed.predictions(spark, out).collect()}

    add("b0")
    assert run() == {}                                                   # no model yet: the epoch stays pending
    registry.publish(spark, models, 1, m1, side)
    assert committed.score_pending(spark, out, chooser) == 1             # and is scored once
    add("b1")
    assert run() == {"b0": "model_v0001", "b1": "model_v0001"}
    registry.publish(spark, models, 2, m2, side)
    add("b2")
    got = run()
    assert got == {"b0": "model_v0001", "b1": "model_v0001", "b2": "model_v0002"}   # never re-scored
    assert committed.predictions(spark, out).count() == 9


def test_watermarked_volume_matches_additive_when_nothing_is_late(spark, tmp_path):
    from datetime import datetime, timedelta
    from ordersight.options import WindowOptions
    W = WindowOptions(60, 1)
    src = str(tmp_path / "feats")
    t0 = datetime(2024, 5, 1, 10, 0, 30)
    schema = "order_id string, timestamp timestamp, batch string, batch_time timestamp, pos long"
    spark.createDataFrame([(f"o{i}", t0 + timedelta(seconds=37 * i), "b", t0, i) for i in range(200)], schema) \
        .write.parquet(src)
    stream = spark.readStream.schema(schema).parquet(src)
    out = str(tmp_path / "out")
    jobs.watermarked_volume_stream(stream, W, out, str(tmp_path / "ck"), "10 minutes").awaitTermination()
    jobs.volume_stream(spark.readStream.schema(schema).parquet(src), W, out, str(tmp_path / "ck2")).awaitTermination()
    a = {r.bucket: r.orders for r in jobs.watermarked_counts(spark, out).collect()}
    b = {r.bucket: r.orders for r in jobs.merged_bucket_counts(spark, out).collect()}
    assert a == b and sum(a.values()) == 200


def test_replayed_epoch_overwrites_itself_and_summary(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(i,) for i in range(5)], "x long")
    jobs._write_epoch(df, out, 3)
    jobs._write_epoch(df, out, 3)            # a replay of the same micro-batch
    jobs._write_epoch(df, out, 4)
    assert spark.read.parquet(out).count() == 10


def test_approximate_summary_close_to_exact(spark):
    from ordersight.operators import metrics
    import random
    rng = random.Random(1)
    p = spark.createDataFrame([(f"o{i}", round(rng.random(), 3), 0, "model_v0001") for i in range(3000)],
                              "order_id string, late_probability double, predicted_late int, checkpoint_id string")
    a = metrics.score_summary(p).first()
    b = metrics.score_summary(p, exact=False).first()
    assert a.n == b.n and abs(a.p50 - b.p50) < 0.01 and abs(a.p90 - b.p90) < 0.01


def _csv_records(data: bytes):
    """Brute force, character by character: the records with their verbatim text, blank lines and header dropped."""
    records, here, state = [], "", "start"      # start of a field, plain, quoted, after a closing quote
    for ch in data.decode("utf-8"):
        here += ch
        if state == "quoted":
            state = "closed" if ch == '"' else "quoted"
        elif ch == '"' and state in ("start", "closed"):
            state = "quoted"
        elif ch == "\n":
            records.append(here.rstrip("\r\n"))
            here, state = "", "start"
        else:
            state = "start" if ch == "," else "plain"
    records.append(here.rstrip("\r\n"))
    return [r for r in records if r][1:]


def _random_field(rnd):
    kind = rnd.random()
    if kind < 0.45:
        return rnd.choice(["A1", "12.5", "2024-05-01T12:00:01Z", "", "x y", "n/a"])
    if kind < 0.55:
        return rnd.choice(['12"5', 'a"b"', 'z""'])                       # a quote inside a plain field is literal
    body = "".join(rnd.choice(["ab", ",", "\n", "\r\n", '""', " ", "\n\n", "q"]) for _ in range(rnd.randint(0, 4)))
    tail = rnd.choice(["", "", "x", 'y"'])                              # text after the closing quote
    return f'"{body}"{tail}'


def _random_file(rnd, n):
    nl = rnd.choice(["\n", "\r\n"])
    rows = [HEADER]
    for _ in range(n):
        rows.append("" if rnd.random() < 0.05 else ",".join(_random_field(rnd) for _ in range(rnd.randint(1, 7))))
    return (nl.join(rows) + nl).encode()


def test_exact_reader_matches_csv_module_across_split_blocks(spark, tmp_dir):
    import random
    rnd = random.Random(11)
    files = {f"orders_20240501T1200{i:02d}Z_000{i}.csv": _random_file(rnd, n)
             for i, n in enumerate([3, 40, 200, 150000])}                  # the last one spans several splits
    for name, data in files.items():
        write_bytes(os.path.join(tmp_dir, name), data)
    assert max(len(d) for d in files.values()) > 3 * (1 << 20)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    try:
        assert raw_files._text_lines(spark, tmp_dir).select("file", "block").distinct().count() > len(files)
        got = {}
        for r in raw_files.read_exact(spark, tmp_dir).orderBy("file", "pos").collect():
            got.setdefault(r.file, []).append(r.raw_line)
        multi = {r.file: r.multiline for r in raw_files.needs_exact_reader(spark, tmp_dir).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name, data in files.items():
        want = _csv_records(data)
        assert got.get(name, []) == want, name
        assert multi[name] == any("\n" in w for w in want), name


def test_file_quarantine_bom_without_final_newline_and_clean_crlf(spark, tmp_dir):
    body = HEADER + "\r\nA,2024-05-01T12:00:01Z,3,15,10,1"               # CRLF, no final newline
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0001.csv", body.encode())
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0002.csv", b"\xef\xbb\xbf" + body.encode())
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0003.csv", (HEADER + "\n").encode())   # header only
    got = {r.file[-8:-4]: r.reason for r in raw_files.file_quarantine(spark, tmp_dir).collect()}
    assert got == {"0001": None, "0002": "unexpected header", "0003": None}


def test_exact_reader_header_is_the_first_line(spark, tmp_dir):
    batch_file(tmp_dir, "20240501T120000Z_0001", ["A,2024-05-01T12:00:01Z,3,15,10,1"], header="")   # blank first line
    batch_file(tmp_dir, "20240501T120000Z_0002", ["B,2024-05-01T12:00:01Z,3,15,10,1"],
               header='"order_id\nx",timestamp')                                              # header spans lines
    batch_file(tmp_dir, "20240501T120000Z_0003", ["C,2024-05-01T12:00:01Z,3,15,10,1"], newline="\r\n")
    got = [(r.file[-8:-4], r.raw_line) for r in raw_files.read_exact(spark, tmp_dir).collect()]
    assert got == [("0003", "C,2024-05-01T12:00:01Z,3,15,10,1")]


def _record(order, distance="3"):
    return f"{order},2024-05-01T12:00:01Z,{distance},15,10,1"


def _odd_folder(d):
    good = (HEADER + "\n" + _record("A") + "\n").encode()
    limit = raw_files.FIELD_LIMIT
    files = {
        "0001": good,
        "0002": b"\xef\xbb\xbf" + good,
        "0003": good.replace(b"A,", b"\xe9,"),
        "0004": good.replace(b"A,", b"A\x00,"),
        "0005": b"",
        "0006": (HEADER + "\n" + _record("x" * limit) + "\n").encode(),                     # the longest field allowed
        "0007": (HEADER + "\n" + _record("x" * (limit + 1)) + "\n").encode(),
        "0008": (HEADER + "\n" + _record("B") + '\nC,"never closed\n' + "y" * 50 + "\n" + "line of it\n" * 20000).encode(),
        "0009": (HEADER + "\n" + _record("D", '"3\n""x"') + "\n" + _record("E") + "\n").encode(),     # a record over two lines
        "0010": (HEADER + '\nF,"' + "ab\n" * (limit // 3) + '"\n' + _record("G") + "\n").encode(),    # within the limit
        "0011": (HEADER + '\nF,"' + '""\n' * (limit // 2) + '",x,"' + "q\n" * (limit // 2) + 'qqq"\n').encode(),
    }
    for k, data in files.items():
        write_bytes(os.path.join(d, f"orders_20240501T1200{k[2:]}Z_{k}.csv"), data)
    too_long = raw_files.TOO_LONG
    return {"0001": None, "0002": "unexpected header", "0003": "not UTF-8 text", "0004": "malformed CSV (NUL byte)", "0005": "empty file",
            "0006": None, "0007": too_long, "0008": too_long, "0009": None, "0010": None, "0011": too_long}


def test_unusable_files_become_ledger_rows_in_batch_and_stream(spark, tmp_path):
    """SRC-03, ST-08: every unusable file is one skipped ledger row with its reason, and gives no rows."""
    raw = tmp_path / "raw"
    raw.mkdir()
    want = _odd_folder(str(raw))
    batch_out, stream_out = str(tmp_path / "b"), str(tmp_path / "s")
    assert jobs.clean_files(spark, str(raw), batch_out) == len(want)
    jobs.clean_stream(raw_files.raw_text_stream(spark, str(raw)), to_raw, stream_out, str(tmp_path / "ck")).awaitTermination()
    for out in (batch_out, stream_out):
        o = jobs.stream_outputs(spark, out)
        got = {r.batch[-4:]: (r.status, r.skip_reason) for r in o["ledger"].collect()}
        # an empty file gives a stream no line, so only the listing of a batch run shows it
        assert got == {k: ("skipped", w) if w else ("committed", None) for k, w in want.items() if w != "empty file" or out == batch_out}
        assert sorted(r.order_id[0] for r in o["features"].collect()) == ["A", "E", "G", "x"]
        assert {(r.order_id, r.reason) for r in o["rejects"].collect()} == {("D", "not_a_number"), ("F", "wrong_field_count")}
    assert jobs.clean_files(spark, str(raw), batch_out) == 0                     # nothing left to do, skipped files included
    batch_file(str(raw), "20240501T130000Z_0020", [_record("H")])
    assert jobs.clean_files(spark, str(raw), batch_out) == 1
    led = jobs.stream_outputs(spark, batch_out)["ledger"]
    assert {r.batch[-4:]: r.epoch for r in led.where("epoch > 0").collect()} == {"0020": 1}


def test_open_field_lengths_match_the_csv_module(spark, tmp_dir):
    import csv
    import io
    import random
    rnd = random.Random(4)
    data = _random_file(rnd, 3000).decode()
    write_bytes(f"{tmp_dir}/orders_20240501T120000Z_0001.csv", data.encode())
    k = raw_files.record_keys(raw_files._text_lines(spark, tmp_dir))
    got = sorted(r.length for r in raw_files.open_field_lengths(k).collect())
    # the inside of every quoted field that holds a line end, without what follows the closing quote
    want = []
    for rec in csv.reader(io.StringIO(data, newline="")):
        want += [f for f in rec if "\n" in f]
    tails = [len(f) - max(len(f.rstrip("x")), len(f[:-2]) if f.endswith('y"') else 0) for f in want]
    assert len(got) == len(want)
    assert sum(got) <= sum(map(len, want)) <= sum(got) + 2 * len(want) and all(t <= 2 for t in tails)


def _clean(spark, out, epoch_id, batch, orders):
    from datetime import datetime
    rows = [(batch, datetime(2024, 5, 1, 12), i, _record(o)) for i, o in enumerate(orders)]
    raw = spark.createDataFrame(rows, "batch string, batch_time timestamp, pos long, raw_line string")
    status = spark.createDataFrame([(f"{batch}.csv", batch, None)], "file string, batch string, skip_reason string")
    jobs.clean_epoch(raw, status, out, epoch_id)


def test_replayed_failed_and_empty_epochs_leave_predictions_and_counts(spark, tmp_path):
    """ST-03/04/07/11: downstream follows the ledger: a replay changes nothing, a half-written epoch is not seen."""
    from pyspark.sql import functions as F
    from ordersight.options import WindowOptions
    from ordersight.streaming import committed
    out, W = str(tmp_path / "out"), WindowOptions(60, 1)
    calls = []

    def model():
        calls.append(1)
        return {"distance_km": 0.6, "prep_minutes": 0.25}, -7.0, f"model_v{len(calls):04d}"

    def run():
        committed.score_stream(spark, out, model, str(tmp_path / "ck1")).awaitTermination()
        committed.volume_stream(spark, out, W, str(tmp_path / "ck2")).awaitTermination()
        p = {(r.order_id, r.checkpoint_id) for r in committed.predictions(spark, out).collect()}
        assert committed.predictions(spark, out).count() == len(p)
        return p, sum(r.orders for r in committed.bucket_counts(spark, out).collect())

    _clean(spark, out, 0, "20240501T120000Z_0001", [])                            # a first epoch without rows
    o = jobs.stream_outputs(spark, out)
    assert o["features"].count() == 0 and o["ledger"].count() == 1
    assert run() == (set(), 0)
    _clean(spark, out, 1, "20240501T120100Z_0002", ["a", "b", "c"])
    first = {("a", "model_v0002"), ("b", "model_v0002"), ("c", "model_v0002")}
    assert run() == (first, 3)
    _clean(spark, out, 1, "20240501T120100Z_0002", ["a", "b", "c"])                # replay: new files, the same epoch
    assert run() == (first, 3)
    # data without a ledger row: the epoch failed in between
    half = jobs.stream_outputs(spark, out)["features"].sparkSession.read.schema(jobs.ANNOTATED).parquet(f"{out}/annotated").where("epoch = 1")
    jobs._write_epoch(half.withColumn("t_order_id", F.concat("t_order_id", F.lit("2"))).drop("epoch"), f"{out}/annotated", 2)
    assert run() == (first, 3)
    _clean(spark, out, 2, "20240501T120200Z_0003", ["d"])                          # and is run again
    assert run() == (first | {("d", "model_v0003")}, 4)
    # the scorer failed before its own ledger row: what it wrote is replaced
    import shutil
    shutil.rmtree(f"{out}/score_ledger/epoch=2")
    p, n = run()
    assert committed.score_pending(spark, out, model) == 1
    assert {(r.order_id, r.checkpoint_id) for r in committed.predictions(spark, out).collect()} == first | {("d", "model_v0004")}
    # a batch delivered again in another epoch is not scored again
    _clean(spark, out, 3, "20240501T120200Z_0003", ["d"])
    committed.score_pending(spark, out, model)
    assert committed.predictions(spark, out).count() == 4


def test_scoring_waits_for_a_model_and_refuses_bad_probabilities(spark, tmp_path):
    from ordersight.streaming import committed
    out = str(tmp_path / "out")
    _clean(spark, out, 0, "20240501T120000Z_0001", ["a"])
    assert committed.score_pending(spark, out, lambda: None) == 0                  # no model yet: still pending
    assert committed.predictions(spark, out).count() == 0
    broken = lambda: ({"distance_km": float("nan")}, 0.0, "model_v0001")           # noqa: E731
    assert committed.score_pending(spark, out, broken) == 1
    led = committed.table_at(spark, f"{out}/score_ledger", committed.SCORE_LEDGER).collect()
    assert [(r.status, r.skip_reason) for r in led] == [("skipped", "model_v0001 produced non-finite probabilities")]
    assert committed.predictions(spark, out).count() == 0
