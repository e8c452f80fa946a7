"""Chat templates and archives: exact round trips."""

import hashlib
import random

import pytest

from ledgerline.llm import chat_format as C
from ledgerline.llm import mixing as M
from ledgerline.llm import warc as W


def test_escaping_is_reversible():
    pick = random.Random(1)
    bits = ["%", "%25", "%3C", "<", "|", "<|end|>", "<|turn|>", "<s>", "</s>", "[INST]", "[/INST]", "\n", "é", "a", "[", "%0A", "<|image:0|>"]
    for _ in range(5000):
        text = "".join(pick.choices(bits, k=pick.randint(0, 8)))
        for what in (C.CONTROL, C.ROLE):
            safe = C.escape(text, what)
            assert C.unescape(safe) == text
            assert not any(x in safe for x in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_conversations_round_trip(spark):
    pick = random.Random(2)
    rows = []
    for conv in [1, 2, 3, None, -5]:
        for turn in range(pick.randint(1, 6)):
            rows.append((conv, turn, pick.choice(["user", "assistant", None, "a\nb"]), pick.choice([None, "", "<|end|>\n", "50% <s> é", "plain"])))
    rows += [(1, None, "assistant", "first"), rows[0], rows[0]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, formatted int")
    chats = C.format_chats(df)
    got = {r.conv_id: r for r in C.read_back(chats).collect()}
    texts = {r.conv_id: r.formatted for r in chats.collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        plain = [(r[2] or "", r[3] or "") for r in turns]
        assert sorted(C.read(texts[conv])) == sorted(plain)
        assert [x[0] for x in C.read(texts[conv])] == [x[0] for x in plain]
        loss = "".join(t for role, t in C.read(texts[conv]) if role == "assistant")
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(turns), len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in C.read(texts[conv])).encode()).hexdigest()
        assert got[conv].formatted_chars == len(texts[conv])
    assert C.format_chats(df.limit(0)).count() == 0


def test_typed_parts(spark):
    parts = [("text", "see <|image:0|>", None, None, None, None, None), ("image", None, "s3://a.png", 400, 300, None, None),
             ("audio", None, "b.wav", None, None, 2.5, None), ("text", "and", None, None, None, None, None), ("document", None, "c.pdf", None, None, None, 3)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [("image", None, None, None, None, None, None)]), (2, 0, "user", None)],
                               f"conv_id long, turn long, role string, parts array<{C.PART}>")
    got = {r.conv_id: r for r in C.format_chats(df).collect()}
    assert got[1].formatted == "<|turn|>user\nsee %3C|image:0|><|image:0|><|audio:1|>and<|document:2|><|end|>\n<|turn|>assistant\n<|image:0|><|end|>\n" \
        .replace("<|image:0|><|end|>\n<|turn|>", "<|image:0|><|end|>\n<|turn|>")
    assert [(a.place, a.n, a.kind, a.ref, a.tokens) for a in got[1].attachments] == [
        (0, 0, "image", "s3://a.png", 2 * C.TILE_TOKENS), (0, 1, "audio", "b.wav", 63), (0, 2, "document", "c.pdf", 3 * C.PAGE_TOKENS),
        (1, 0, "image", None, C.TILE_TOKENS)]
    assert got[1].expanded_tokens == sum(a.tokens for a in got[1].attachments)
    assert [(s.start, s.end) for s in got[1].loss] == [(got[1].formatted.rindex("<|image"), got[1].formatted.rindex("<|end|>"))]
    assert got[2].formatted == "<|turn|>user\n<|end|>\n" and got[2].attachments == []
    with pytest.raises(ValueError):
        C.flatten_turn("user", [{"kind": "video"}])


def pages():
    pick = random.Random(5)
    same = ["<p>one</p>", "", "é" * 50, None]
    rows = [(i * pick.choice([1, 7]), f"http://h/{i}?a=%20\n", pick.choice(same) if pick.random() < 0.4 else f"<p>{pick.random()}</p>" * pick.randint(1, 400)) for i in range(300)]
    return rows + [(None, None, "only null"), (None, "u", "<p>one</p>"), rows[3], rows[3]]


@pytest.mark.parametrize("least", [0, 20])
def test_archive_round_trip(spark, tmp_path, least):
    rows = pages()
    df = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, shard int")
    folder = str(tmp_path / f"w{least}")
    manifest = W.write_archive(df, folder, least=least, file_bytes=5_000, shard_bytes=20_000)
    assert manifest.count() > 5
    best = {}
    for i, _, h in rows:
        key = h or ""
        best[key] = max(best.get(key, i), i, key=lambda x: (x is not None, x or 0))
    want = []
    for i, u, h in rows:
        raw = (h or "").encode()
        answers = i == best[h or ""] or len(raw) < least
        want.append((i, len(raw), W.base32_sha1(raw), "response" if answers else "revisit", None if answers else best[h or ""]))
    back = W.read_archive(manifest, folder).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back]
    assert sorted(map(str, got)) == sorted(map(str, want))
    payloads = {(h or "").encode() for _, _, h in rows}
    assert {bytes(r.payload) for r in back if r.record_type == "response"} == payloads


def test_shards_are_ranges_of_ids(spark, tmp_path):
    """One id far away, ids at both ends of the range, one id repeated beyond a shard, and none."""
    rows = [(i, f"u{i}", f"<p>{i}</p>" * 30) for i in range(2000)] + [(10**12, "far", "far"), (2**63 - 1, "top", "top"), (-(2**63), "low", "low")]
    rows += [(777, f"again{k}", f"again {k} " * 50) for k in range(200)] + [(None, f"none{k}", f"none {k} " * 50) for k in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = W.write_archive(df, str(tmp_path / "r"), file_bytes=1 << 20, shard_bytes=30_000)
    spans = {}
    for m in manifest.collect():
        found = W.read_archive(manifest.filter(M.F.col("file") == m["file"]), str(tmp_path / "r")).collect()
        ids = [(r.page_id is not None, r.page_id or 0) for r in found]
        assert ids == sorted(ids)
        spans.setdefault(m["shard"], []).extend(ids)
    order = [spans[k] for k in sorted(spans)]
    assert sum(map(len, order)) == len(rows) and len(order) > 30
    for a, b in zip(order, order[1:]):
        assert max(a) <= min(b)
    assert all(max(a) < min(b) or min(b) == max(a) in ((False, 0), (True, 777)) for a, b in zip(order, order[1:]))


def test_same_bytes_whatever_the_partitions(spark, tmp_path):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string")
    seen = []
    for k in (1, 7):
        manifest = W.write_archive(df.repartition(k), str(tmp_path / f"p{k}"), file_bytes=5_000, shard_bytes=20_000)
        seen.append(sorted(map(tuple, manifest.collect())))
    assert seen[0] == seen[1]
    assert not list((tmp_path / "p1").glob("_tmp*"))


def test_damage_is_noticed(spark, tmp_path):
    df = spark.createDataFrame(pages()[:5], "page_id long, url string, html string")
    folder = tmp_path / "d"
    manifest = W.write_archive(df, str(folder))
    file = folder / manifest.first()["file"]
    file.write_bytes(file.read_bytes()[:-3])
    with pytest.raises(Exception):  # noqa: B017
        W.read_archive(manifest, str(folder)).collect()
    assert W.read_archive(W.write_archive(df.limit(0), str(tmp_path / "none")), str(tmp_path / "none")).count() == 0
