"""Numbered lines of split files, symbol lists in several tasks, full RFC 3339."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from marketlake.functions import scalars as S
from marketlake.sources import frames as SF, statements as ST
from marketlake.sources.lines import numbered_lines


def small_splits(spark, size="3000"):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")


def restore(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_numbers_follow_files_that_are_split(spark, tmp_path):
    rng = random.Random(0)
    want = {}
    for k in range(4):
        folder = tmp_path / f"day={k}"
        folder.mkdir()
        lines = ["x" * rng.choice([0, 1, 40, 400]) + f" {n}" if rng.random() < 0.9 else "" for n in range((500, 1, 40, 0)[k])]
        end = rng.choice(["", "\n"]) if lines else ""
        (folder / "a.txt").write_text("\n".join(lines) + end)
        want |= {(k, n): line for n, line in enumerate(lines)}
    (tmp_path / "day=0" / "b.txt").write_text("one\r\ntwo\rstill two\n\n" + "long " * 2000 + "\nlast")
    small_splits(spark)
    try:
        lines = numbered_lines(spark, str(tmp_path)).cache()
        got = {(r.day, r.line_no): r.line for r in lines.filter(F.col("file").endswith("a.txt")).collect()}
        if (0, 499) in want and want[0, 499] == "" and (0, 499) not in got:
            want.pop((0, 499))  # an empty text behind the last line feed is no line
        assert got == want
        other = [r.line for r in lines.filter(F.col("file").endswith("b.txt")).orderBy("line_no").collect()]
        assert other == ["one", "two\rstill two", "", "long " * 2000, "last"]
        scan = spark.read.text(str(tmp_path))
        assert scan.rdd.getNumPartitions() > 10  # one file in many tasks
    finally:
        restore(spark)


def test_raw_capture_in_order_of_its_lines(spark, tmp_path):
    (tmp_path / "c.txt").write_text("".join(f'[{{"n":{n}}}]\n' for n in range(3000)))
    small_splits(spark)
    try:
        rows = SF.read_frame_lines(spark, str(tmp_path)).orderBy("frame_no").collect()
    finally:
        restore(spark)
    assert [r.body for r in rows] == [f'[{{"n":{n}}}]' for n in range(3000)]
    assert [r.frame_no._line for r in rows] == list(range(3000))


def plain_symbols(text):
    """The rules of a symbol list, line by line."""
    out = []
    lines = text.split("\n")
    for n, line in enumerate(lines[:-1] if text.endswith("\n") else lines):
        line = line.removesuffix("\r").strip()
        if line and not (n == 0 and line.lower().startswith("symbol")):
            cell = line.split(",")[0].strip()
            if cell:
                out.append((n, cell))
    return out


def test_symbol_list_is_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(1)
    texts = {}
    for k, head in enumerate(["Symbol,Name\r\n", "symbols\n", "", "IBM\n"]):
        body = "".join(rng.choice([f" S{n} , name {n}", f"S{n}", "", "  ", ", none", " ", "Symbol,again", f" Q{n} ,x"]) +
                       rng.choice(["\r\n", "\n"]) for n in range(1500))
        texts[f"l{k}.csv"] = head + body + rng.choice(["", "END"])
        (tmp_path / f"l{k}.csv").write_bytes(texts[f"l{k}.csv"].encode())
    small_splits(spark)
    try:
        got = {}
        for r in ST.read_symbols(spark, str(tmp_path)).collect():
            got.setdefault(os.path.basename(r.file), []).append((r.line_no, r.symbol))
        one = [r.symbol for r in ST.read_symbols(spark, str(tmp_path / "l0.csv")).orderBy("line_no").collect()]
    finally:
        restore(spark)
    want = {k: plain_symbols(t) for k, t in texts.items()}
    assert {k: sorted(v) for k, v in got.items()} == want
    assert one == [s for _, s in want["l0.csv"]]
    for k, t in texts.items():
        rows = ST.load_symbols(spark.createDataFrame([(t,)], "value string")).collect()
        assert sorted((r.line_no, r.symbol) for r in rows) == want[k]


def plain_time(text):
    """RFC 3339 by Python's own parts; None where it does not conform."""
    import re
    m = re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)[Tt ](\d\d):(\d\d):(\d\d)(?:[.](\d+))?(?:([Zz])|([+-])(\d\d):(\d\d))", text, re.ASCII)
    if not m:
        return None
    y, mo, d, h, mi, s = map(int, m.groups()[:6])
    zh, zm = (0, 0) if m[8] else (int(m[10]), int(m[11]))
    if s > 60 or zm > 59 or zh > 23:
        return None
    try:
        at = dt.datetime(y, mo, d, h, mi, min(s, 59), int((m[7] or "0")[:6].ljust(6, "0")))
    except ValueError:
        return None
    return at + dt.timedelta(seconds=s == 60) - (1 if m[9] != "-" else -1) * dt.timedelta(hours=zh, minutes=zm)


def test_time_stamps_against_plain_python(spark):
    rng = random.Random(2)
    texts = ["2016-12-31T23:59:60Z", "2016-12-31T23:59:60.5Z", "2024-06-30T10:00:60+19:00", "2024-02-29T00:00:00-23:59",
             "2024-01-01T00:00:00+24:00", "2024-01-01T00:00:00+23:60", "2024-01-01T00:00:61Z", "2024-01-01T24:00:00Z", "", "Z",
             "2024-01-01T00:00:00", "2023-02-29T00:00:00Z", "2024-01-01T00:00:00.Z", "2024-01-01T00:00:00.123456789+05:30",
             "2024-1-01T00:00:00Z", "2024-01-01T00:00:00Z ", "2024-01-01t00:00:00z", "2024-01-01 00:00:00-00:00", "１２３４-01-01T00:00:00Z"]
    for _ in range(400):
        z = rng.choice(["Z", "z", "+05:30", f"{rng.choice('+-')}{rng.randint(0, 25):02}:{rng.randint(0, 62):02}"])
        f = rng.choice(["", f".{rng.randint(0, 10 ** 9)}"])
        texts.append(f"{rng.randint(1990, 2040)}-{rng.randint(1, 12):02}-{rng.randint(1, 31):02}T{rng.randint(0, 24):02}:"
                     f"{rng.randint(0, 60):02}:{rng.randint(55, 61)}{f}{z}")
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = {r.v: r.t for r in df.select("v", S.ts_lenient("v").alias("t")).collect()}
    assert got == {t: plain_time(t) for t in texts}
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert {r.v: r.t for r in df.select("v", S.ts_strict("v").alias("t")).collect()} == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
