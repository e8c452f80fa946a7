"""Files in blocks: quoted CSV against Python's reader, digests against whole-file ones, one feed build per query."""

import csv
import hashlib
import random

from ledgerline.session import fresh_path
from ledgerline.sources import blocks as B
from ledgerline.sources import files, lineage


def messy_rows(n, seed=3):
    pick = random.Random(seed)
    bits = ["a", "é", '"', "\n", ",", " ", "\r\n", "xyz", '""', "0"]
    word = lambda: "".join(pick.choices(bits, k=pick.randint(1, 12)))
    return [(str(i), pick.choice([None, "", word(), word()]), word() if pick.random() < 0.9 else "long " * 200) for i in range(n)]


def write(path, rows, header):
    def field(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"'

    with open(path, "w", newline="") as f:
        f.write(("k,v,w\n" if header else "") + "".join(",".join(map(field, r)) + "\n" for r in rows))


def test_blocks_of_any_size_give_every_record_once(spark, tmp_path):
    rows = messy_rows(300)
    write(tmp_path / "a.csv", rows, True)
    with open(tmp_path / "a.csv", newline="") as f:
        assert len(list(csv.reader(f))) == 301
    for size in (7, 64, 1000, 1 << 20):
        whole = (tmp_path / "a.csv").stat().st_size
        got, quoted = [], False
        with B.opened(f"file:{tmp_path}/a.csv") as f:
            for start in range(0, whole, size):
                stop = min(whole, start + size)
                data = B.block_records(f, start, stop, quoted)
                quoted ^= f.read_at(stop - start, start).count(b'"') % 2 == 1
                if data:
                    got += [tuple(r.values()) for b in B.text_rows(data, 3, ",", start == 0) for r in b.to_pylist()]
        assert sorted(got, key=lambda r: r[0]) == sorted(rows, key=lambda r: r[0])


def test_scan_is_shared_and_equals_the_whole_file_scan(spark, tmp_path):
    rows = messy_rows(400, 5)
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", rows[:250], True)
    write(folder / "b.csv", rows[250:], True)
    (folder / "c.csv").write_bytes(b"")
    (folder / "d.csv").write_bytes(b"k,v,w\n")
    got = B.read_quoted_csv(spark, str(folder), ["k", "v", "w"], block_bytes=2000)
    assert got.rdd.getNumPartitions() > 5
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(rows, key=key)
    plain = [r for r in rows if "\r" not in (r[1] or "") + r[2]]
    again = files.write_csv(spark.createDataFrame(plain, "k string, v string, w string"), fresh_path(spark, "t"))
    old, new = (sorted(map(tuple, f(spark, again, ["k", "v", "w"]).collect()), key=key) for f in (files.read_text_csv, B.read_quoted_csv))
    assert old == new == sorted(plain, key=key)


def test_uneven_records(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes(b'a,b\n1,2\n3\n"4","",6\n\n7,8')
    got = B.read_quoted_csv(spark, str(tmp_path / "u.csv"), ["a", "b"], block_bytes=5).collect()
    assert sorted(map(tuple, got)) == [("1", "2"), ("3", None), ("4", ""), ("7", "8")]


def test_digest_over_many_pieces(spark, tmp_path, monkeypatch):
    data = random.Random(1).randbytes(100_000)
    for name, part in (("x y%1.bin", data), ("empty.bin", b"")):
        (tmp_path / name).write_bytes(part)
    monkeypatch.setattr(lineage, "PIECE", 999)
    got = {r.file_name: (r.bytes, r.sha256_12) for r in lineage.file_fingerprints(spark, [str(tmp_path)]).collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()[:12]) for n, d in (("x y%1.bin", data), ("empty.bin", b""))}


def test_cleaning_queries_build_the_feed_once(spark, tables):
    import __spark_entry__ as entry

    for name in ("reconciliation", "acceptance_tests", "clean_fact", "quarantine"):
        plan = entry.queries()[name](spark, tables.root)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan, name
