"""Sharding, decontamination, line dedup, packing, personal data and licences against plain Python."""

import hashlib
import random
import re
from importlib import resources
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusflow.llm import linedup, packing, pii, sharding
from corpusflow.llm.decontaminate import contaminated_words, drop_contaminated
from corpusflow.llm.licenses import scan_licenses

DOCS = "doc_id BIGINT, text STRING"
CLASHING = "doc_id BIGINT, text STRING, TEXT STRING, Size INT, shard STRING, spans INT, words INT"


def clashing(rows):
    return [(doc_id, text, "other", 1, "s", 2, 3) for doc_id, text in rows]


# --- sharding -------------------------------------------------------------------------------------


def plain_shards(rows, n, blocks=sharding.BLOCKS_PER_SHARD):
    """Rows in key order, each in the range that its share of bytes before it says."""
    sizes = [len((text or "").encode()) + 16 for _, text in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0]))
    total, before, found = sum(sizes), 0, []
    for i in order:
        found.append((rows[i][0], sizes[i], before * n * blocks // total // blocks))
        before += sizes[i]
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_shards_of_unique_keys(spark, seed):
    rng = random.Random(seed)
    rows = [(i * i - 500, "x" * rng.choice([0, 3, 50, 400])) for i in range(400)] + [(-(2**62), "é" * 9), (2**63 - 1, None)]
    rng.shuffle(rows)
    got = sharding.histogram_sort(spark.createDataFrame(rows, DOCS), 7).collect()
    assert sorted((r["doc_id"], r["size"], r["shard"]) for r in got) == sorted(plain_shards(rows, 7))
    for shard in range(7):
        mine = sorted((r["slot"], r["doc_id"]) for r in got if r["shard"] == shard)
        assert [slot for slot, _ in mine] == list(range(len(mine)))
        assert [doc_id for _, doc_id in mine] == sorted(doc_id for _, doc_id in mine)


def test_shards_of_a_hot_key(spark):
    rows = [(7, "same text")] * 600 + [(i, "t" * (i % 5)) for i in range(300)] + [(None, "n")] * 40
    got = sharding.histogram_sort(spark.createDataFrame(clashing(rows), CLASHING), 10)
    assert got.columns == ["doc_id", "text", "spans", "words", "size", "shard", "slot"]
    got = got.collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in got))) == sorted(map(repr, rows))
    by_shard = [sum(r["size"] for r in got if r["shard"] == s) for s in range(10)]
    assert max(by_shard) - min(by_shard) <= 2 * max(r["size"] for r in got)
    for s in range(10):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    keys = [{r["doc_id"] for r in got if r["shard"] == s and r["doc_id"] is not None} for s in range(10)]
    assert all(max(a) <= min(b) for a, b in zip(keys, keys[1:], strict=False) if a and b)


def test_shards_of_few_rows(spark):
    assert sharding.histogram_sort(spark.createDataFrame([], DOCS), 5).count() == 0
    got = sharding.histogram_sort(spark.createDataFrame([(1, "a"), (2, None)], DOCS), 40).collect()
    assert [(r["doc_id"], r["slot"]) for r in sorted(got)] == [(1, 0), (2, 0)]


# --- decontamination ------------------------------------------------------------------------------


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_hits(text, items):
    words, hit, names = plain_words(text), set(), set()
    for item_id, item in items:
        own = plain_words(item)
        n = min(len(own), 10)
        for i in range(len(own) - n + 1) if own else ():
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit.update(range(j, j + n))
                    names.add(item_id)
    return len(words), len(hit), sorted(str(name) for name in names if name is not None)


def test_windows(spark):
    rng = random.Random(4)
    vocabulary = ["the", "Of", "a1", "éa", "ünd", "b"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", ".\n", "-", "\x7f"]) for _ in range(n))

    items = [(i, text(rng.choice([10, 12, 25]))) for i in range(6)]
    items += [(90, "Of a1 éa b b the the"), (91, ""), (92, None), (93, "..."), (None, items[0][1]), (3, items[1][1]), (10, "zz yy"), (10, "zz")]
    rows = [(i, text(rng.choice([0, 5, 9, 10, 11, 60, 200]))) for i in range(40)]
    rows += [(100 + i, text(8) + items[i % 6][1][5:] + text(4)) for i in range(12)]
    rows += [(7, items[0][1]), (7, items[0][1]), (None, items[2][1].upper()), (200, None), (201, ""), (202, "zz"), (203, "zz yy yy zz"), (204, items[3][1] * 40)]
    got = contaminated_words(spark.createDataFrame(clashing(rows), CLASHING), spark.createDataFrame(items, "item_id BIGINT, text STRING")).collect()
    want = [(doc_id, *plain_hits(value, items)) for doc_id, value in rows]
    assert sorted(repr((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"])) for r in got) == sorted(map(repr, want))


def test_windows_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (2, None)], DOCS), spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"]) for r in contaminated_words(docs, items).collect()) == [(1, 2, 0), (2, 0, 0)]
    assert contaminated_words(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id BIGINT, text STRING")).count() == 0


def test_contaminated_documents_go(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, "clean text"), (2, f"before {passage[40:]} after"), (None, passage), (3, None), (1, passage)]
    df = spark.createDataFrame(clashing(rows), CLASHING)
    left = drop_contaminated(df, spark.createDataFrame([(1, passage)], "item_id BIGINT, text STRING"))
    assert left.columns == df.columns
    assert sorted(tuple(r)[:2] for r in left.collect()) == [(1, "clean text"), (3, None)]


# --- repeated passages ----------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["", " ", "a b", "x " * 100, "é b c\r\n d " * 9, "q" * 3000 + " r" * 30, "a b c d e f g h i j\n" * 20])
def test_lines(monkeypatch, text):
    data = text.encode()
    words = data.split()
    lines, anchors = linedup.line_table(data)
    plain = [tuple(words[i : i + linedup.BLOCK_WORDS]) for i in range(len(words) - linedup.BLOCK_WORDS + 1)]
    assert len(lines) == len(anchors) == len(plain)
    # equal words and equal hashes are the same thing, and equal lines have equal anchors
    assert len(set(lines.tolist())) == len(set(plain)) == len(set(zip(plain, lines.tolist(), anchors.tolist())))
    monkeypatch.setattr(linedup, "BYTES_AT_ONCE", 7)
    assert all((a == b).all() for a, b in zip(linedup.line_table(data), (lines, anchors)))


def test_texts_are_neither_sorted_nor_counted_to_their_end(spark):
    rng = random.Random(53)
    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    for some in (words, words[:24], words[:25], words[:60] * 3, []):
        data = " ".join(some).encode()
        assert linedup.distinct_anchors(data).tolist() == sorted(set(linedup.line_table(data)[1].tolist()))
    blanks = [" ", "\t\n", "  \x0b\x0c\r "]
    texts = [None, "", " ", *(f"{a}{b.join(words[:n])}{c}" for n in (1, 24, 25, 26, 300) for a in ["", *blanks] for b in blanks for c in ["", *blanks])]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    for least in (1, 7, 25):
        got = {r[0]: r[1] for r in frame.select("doc_id", linedup._has_words(F.col("text"), least)).collect()}
        assert got == {i: len((text or "").split()) >= least for i, text in enumerate(texts)}
    plan = linedup.without_repeated_passages(frame)._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_alignment():
    def blocks(own, other):
        return [list(map(int, row)) for row in zip(*linedup.align(np.array(own), np.array(other)))]

    assert blocks([4, 5, 6], [9, 10, 11]) == [[0, 3, 0]]
    assert blocks([4, 5, 20, 21, 22], [9, 10, 40, 41, 42]) == [[0, 2, 0], [2, 3, 0]]
    assert blocks([4, 5, 20, 21, 22], [40, 41, 1, 2, 3]) == [[0, 2, 1], [2, 3, 0]]  # the longer of two crossing blocks is in order
    assert blocks([1, 2, 30, 31], [7, 8, 7, 8]) == [[0, 2, 1], [2, 2, 1]]  # no line comes once
    assert blocks([1, 2, 30, 31, 32], [7, 8, 7, 8, 9]) == [[0, 2, 1], [2, 3, 0]]  # one does, and its block grows


def test_longest_increasing_run():
    rng = random.Random(1)
    for _ in range(200):
        values = rng.sample(range(12), 8)
        run = linedup._increasing(values)
        assert [values[i] for i in run] == sorted({values[i] for i in run}) and run == sorted(run)
        longest = max(bin(m).count("1") for m in range(256) if (p := [v for i, v in enumerate(values) if m >> i & 1]) == sorted(p))
        assert len(run) == longest


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_repeated_passages_go(spark):
    rng = random.Random(8)
    passage, short = prose(rng, 70), prose(rng, 12)
    rows = [(i, f"{prose(rng, 40)}\n{short}\n{prose(rng, 40)}") for i in range(30)]
    rows += [(100 + i, f"{prose(rng, 30)} {passage} {prose(rng, 30)}") for i in range(20)]
    rows += [(200, rows[3][1]), (201, None), (202, ""), (203, " \n"), (203, rows[4][1]), (None, rows[5][1] + " " + prose(rng, 60)), (3, rows[3][1])]
    df = spark.createDataFrame(clashing(rows), CLASHING)
    left = linedup.without_repeated_passages(df)
    assert left.columns == df.columns
    got = [tuple(r)[:2] for r in left.collect()]
    texts = dict(got)
    assert all(texts[i] == text for i, text in rows[:30] if i != 3)  # a short repeated line stays
    assert texts[100] == rows[30][1]  # the first holder keeps the passage
    middle = " ".join(passage.split()[12:-12])
    assert all(middle not in texts[100 + i] for i in range(1, 20))
    kept = [texts[100 + i].split() for i in range(1, 20)]
    assert all(row[1].split()[:30] == words[:30] and row[1].split()[-30:] == words[-30:] for row, words in zip(rows[31:50], kept, strict=True))
    assert texts[200] == ""  # nothing is left of a copy
    assert 200 not in {r[0] for r in linedup.without_repeated_passages(df, least_words=1).collect()}
    assert texts[201] is None and texts[202] == ""
    assert {text for i, text in got if i == 203} == {" \n", ""}  # blank as it was, and a copy
    assert got.count((3, rows[3][1])) == 2  # equal rows are one document
    assert sum(doc_id is None for doc_id, _ in got) == 1 and rows[5][1][:200] not in next(t for d, t in got if d is None)
    assert linedup.without_repeated_passages(df.limit(0)).count() == 0


def test_what_is_left_stays(spark):
    rng = random.Random(9)
    passage = prose(rng, 40)
    rows = [(1, passage), (2, f"My own title here {passage}"), (3, passage), (4, f"{passage} end"), (5, "four words of text")]
    frame = spark.createDataFrame(rows, DOCS)
    left = {i: text.split() for i, text in linedup.without_repeated_passages(frame).collect()}
    assert left == {1: passage.split(), 2: "My own title here".split(), 3: [], 4: ["end"], 5: "four words of text".split()}
    assert {r[0] for r in linedup.without_repeated_passages(frame, least_words=1).collect()} == {1, 2, 4, 5}
    assert {r[0] for r in linedup.without_repeated_passages(frame, least_words=4).collect()} == {1, 2, 5}


def test_crossing_blocks_are_told_apart(spark):
    rng = random.Random(31)
    one, two, three = prose(rng, 60), prose(rng, 40), prose(rng, 30)
    rows = [(1, f"{one}\n{prose(rng, 20)}\n{two}\n{three}"), (2, f"head of it {two} between them {one} the end"), (3, f"{three} then {three}")]
    frame = spark.createDataFrame(rows, DOCS)
    found = {r.first_id: sorted((b.start, b.words, b.partner_start, b.moved) for b in r.blocks) for r in linedup.common_blocks(frame).collect()}
    assert found == {2: [(3, 40, 80, True), (45, 60, 0, False)], 3: [(0, 30, 120, True), (31, 30, 120, True)]}
    kept = {i: text.split() for i, text in linedup.without_repeated_passages(frame, moved=False).collect()}
    assert kept[2] == ["head", "of", "it", *two.split(), "between", "them", "the", "end"] and kept[3] == rows[2][1].split()
    gone = {i: text.split() for i, text in linedup.without_repeated_passages(frame).collect()}
    assert gone[2] == "head of it between them the end".split() and gone[3] == ["then"]


def plain_without_passages(rows):
    """Texts word by word without all windows of 25 words that stand in a text of a smaller id."""
    held, out = set(), {}
    for doc_id, text in sorted(rows):
        words = text.split()
        windows = [tuple(words[i : i + 25]) for i in range(len(words) - 24)]
        gone = {i + k for i, window in enumerate(windows) if window in held for k in range(25)}
        held |= set(windows)
        out[doc_id] = [word for i, word in enumerate(words) if i not in gone]
    return out


def test_passages_of_any_length_go_whole(spark):
    rng = random.Random(21)
    passages = [prose(rng, n) for n in range(25, 61) for _ in range(4)]
    rows = [(i, f"{prose(rng, 40)} {passage} {prose(rng, 40)}") for i, passage in enumerate(passages)]
    rows += [(1000 + i, f"{prose(rng, 50)} {passage} {prose(rng, 30)}") for i, passage in enumerate(passages)]
    rows += [(2000, f"{passages[9]} {prose(rng, 30)} {passages[3]}"), (2001, f"{prose(rng, 30)} {' '.join(passages[99].split()[:24])} {prose(rng, 30)}")]
    left = dict(linedup.without_repeated_passages(spark.createDataFrame(rows, DOCS)).collect())
    want = plain_without_passages(rows)
    assert {i: text.split() for i, text in left.items()} == want
    assert all(len(want[1000 + i]) <= 80 for i in range(len(passages)))
    assert len(want[2000]) <= 30 and len(want[2001]) == 84


def test_passages_of_hot_pieces_go(spark):
    rng = random.Random(22)
    rows, passages = [], []
    for k in range(12):
        pieces = [prose(rng, 24), prose(rng, 24)]
        lines = [prose(rng, 6) for _ in range(9)]
        # each piece, and each line, stands in earlier documents of its own
        rows += [(100 * k + i, f"{prose(rng, 30)}\n{piece}\n{prose(rng, 30)}") for i, piece in enumerate(pieces + lines)]
        passages += [" ".join(pieces), "\n".join(lines)]
    rows += [(5000 + i, f"{prose(rng, 30)}\n{passage}\n{prose(rng, 30)}") for i, passage in enumerate(passages * 2)]
    rows += [(6000, rows[0][1]), (6001, "short copy"), (6002, "short copy"), (6003, rows[-1][1] + " " + rows[-2][1])]
    left = dict(linedup.without_repeated_passages(spark.createDataFrame(rows, DOCS)).collect())
    want = plain_without_passages(rows)
    assert {i: text.split() for i, text in left.items()} == want
    assert not want[6000] and not want[6003]
    assert all(len(want[5000 + i]) == 60 for i in range(len(passages), 2 * len(passages)))


# --- packing --------------------------------------------------------------------------------------

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
HARD = ["a" * 5000, " " * 3000, "\n\n x\n\n\n y", "it's we'LL 12٣ ½", "👨‍👩‍👧 né", "<|endoftext|> x", "tab\t\t a  b", "\x00\x1c\x85", " lead", "trail "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(name):
    path = str(public_tokenizers.path(name))
    plain = Tokenizer.from_file(path)
    encode = packing.Encoder(path).encode
    assert packing.Encoder(PATH).matcher is not None
    for text in ["", *HARD]:
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(spark):
    rng = random.Random(6)
    texts = [prose(rng, rng.choice([1, 20, 300, 900])) for _ in range(150)] + [prose(rng, 6000), None, "", *HARD]
    rows = [(i, text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(clashing(rows), CLASHING)
    pieces = packing.pack(df, PATH).collect()
    plain, documents, sequences = Tokenizer.from_file(PATH), {}, {}
    for p in pieces:
        documents.setdefault(p["doc_id"], []).append(p)
        sequences.setdefault(p["sequence_id"], []).append(p)
    for doc_id, text in rows:
        own = sorted(documents[doc_id], key=lambda p: p["start"])
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        assert b"".join(p["ids"] for p in own) == np.array(ids, "<u4").tobytes()
        assert [p["start"] for p in own] == np.cumsum([0] + [p["length"] for p in own[:-1]]).tolist()
        assert all(p["doc_tokens"] == len(ids) and len(p["ids"]) == 4 * p["length"] for p in own)
    sizes = []
    for own in sequences.values():
        own = sorted(own, key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == np.cumsum([0] + [p["length"] for p in own[:-1]]).tolist()
        sizes.append(sum(p["length"] for p in own))
    assert max(sizes) <= 1024 and sum(size < 1024 for size in sizes) <= df.rdd.getNumPartitions()
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_repeated_and_null_ids_are_packed(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c")]
    got = packing.pack(spark.createDataFrame(rows, DOCS), PATH).collect()
    assert sorted((repr(p["doc_id"]), p["doc_tokens"]) for p in got) == [("1", 3), ("1", 3), ("None", 2)]


def test_window_of_the_least_sum_of_squares():
    packer = packing.Packer(10, 0)
    for length in (4, 4, 3):
        packer.add(1, bytes(4 * length))
    # two windows of 4 would be 4, and 3 on its own 5; on a 4 it makes 1 + 1
    assert packer.count.tolist() == [0, 0, 0, 0, 1, 0, 0, 1, 0, 0, 0] or packer.count[8] == 1
    counts, rng = packing.Packer(10, 0), random.Random(2)
    for _ in range(300):
        length = rng.randint(1, 9)
        before = counts.count.copy()
        counts.add(1, bytes(4 * length))
        choices = []
        for level in [0, *[i for i in range(1, 10) if before[i] and i + length <= 10]]:
            after = before.copy()
            after[level] -= level > 0
            after[level + length] += level + length < 10
            choices.append(int((after[1:10] ** 2).sum()))
        assert int((counts.count[1:10] ** 2).sum()) == min(choices)


# --- personal data --------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def plain_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": all(int(part) <= 255 for part in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), order, m.end(), kind))
    return sorted(found)


def test_base_spans(spark):
    rng = random.Random(9)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "999.1.1.1", "00001.2.3.04.5", "4111 1111 1111 1111", "4111111111111112", "+1 (555) 555-0100", "+49 30",
             "a@b.c_d@e.f", "é", "👍", " ", ".", "-", "+", "1", "12", "\n", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(250)]
    texts += [None, "", "9" * 30_000, "a@b" + ".c" * 20_000, "+1" + " 2" * 20_000, "1." * 20_000, "q" * 50_000 + "@x", "👍👍 me@x.org 👍"]
    rows = [(i, text) for i, text in enumerate(texts)] + [(3, texts[3]), (None, "z@z.zz 1.1.1.1"), (None, "z@z.zz 1.1.1.1")]
    got = pii.personal_spans(spark.createDataFrame(clashing(rows), CLASHING)).collect()
    found = [(r["doc_id"], [(s["start"], s["order"] - 1, s["end"], s["kind"]) for s in r["spans"] if s["base"]]) for r in got]
    assert sorted(map(repr, found)) == sorted(repr((doc_id, plain_spans(text))) for doc_id, text in rows)


def test_added_spans_touch_no_base_span(spark):
    rng = random.Random(11)

    def card():
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        return next(digits + c for c in "0123456789" if luhn(digits + c))

    rows = [(i, f"pay with {card()} or mail me{i}@x{i}.org today") for i in range(120)]
    rows += [(200 + i, f"see section {i} and table {i * 37} now") for i in range(60)]
    broken = card()
    broken = broken[:-1] + str((int(broken[-1]) + 1) % 10)
    rows.append((500, f"pay with {broken} or mail"))
    got = {r["doc_id"]: r["spans"] for r in pii.personal_spans(spark.createDataFrame(rows, DOCS)).collect()}
    for spans in got.values():
        base = [s for s in spans if s["base"]]
        assert not any(a["kind"] == b["kind"] and a["start"] < b["end"] and b["start"] < a["end"] for a in spans if not a["base"] for b in base)
    assert all(len(got[i]) >= 2 for i in range(120))
    assert all(not got[200 + i] for i in range(60))


def test_redaction(spark):
    rows = [(1, "👍 a@b.cd, 1.2.3.4"), (1, "👍 a@b.cd, 1.2.3.4"), (2, "none"), (3, None), (None, "x a@b.cd")]
    df = spark.createDataFrame(clashing(rows), CLASHING)
    got = pii.redact(df)
    assert got.columns == df.columns
    want = [(1, "👍 [email], [ip]")] * 2 + [(2, "none"), (3, None), (None, "x [email]")]
    assert sorted(repr(tuple(r)[:2]) for r in got.collect()) == sorted(map(repr, want))
    assert pii.personal_spans(df.limit(0)).count() == 0


# --- licences -------------------------------------------------------------------------------------


def test_licenses(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0", "Released under the MIT License."
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    rows = [
        ("a/LICENSE", 1, apache), ("a/b/x.py", 2, "some code " * 50), ("a/b/LICENSE", 3, mit), ("a/b/c/d.py", 4, "more"), ("a/e.py", 5, f"{gpl}\n" + "code " * 200),
        ("z/y.py", 6, "nothing"), ("top.py", 7, None), ("/a//b/z.py", 8, ""), (None, 9, mit), ("a/b", 10, "file named like a directory"), ("a/e.py", 5, "version 3 of the story"),
        ("q/one", 11, "All rights reserved."), ("q/two", 12, mit), ("q/three", 13, "text"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "path STRING, doc_id BIGINT, text STRING, License STRING")
    got = {(r["doc_id"], r["own_license"]): (r["license"], r["inherited_from"]) for r in scan_licenses(df).collect()}
    assert got[1, "Apache-2.0"] == ("Apache-2.0", None)
    assert got[2, None] == ("MIT", "a/b")
    assert got[4, None] == ("MIT", "a/b")
    assert got[5, "GPL-3.0"] == ("GPL-3.0", None)
    assert got[5, None] == ("Apache-2.0", "a")
    assert got[6, None] == (None, None) and got[7, None] == (None, None)
    assert got[8, None] == ("MIT", "a/b")
    assert got[9, "MIT"] == ("MIT", None)
    assert got[10, None] == ("Apache-2.0", "a")
    assert got[13, None] == ("MIT", "q")  # equal cosines: the first name
    assert len(got) == len(rows)
    assert scan_licenses(df.limit(0)).count() == 0


def test_full_texts_speak_for_their_directory(spark):
    folder = resources.files("corpusflow.llm") / "license_texts"
    names = ["Apache-2.0", "BSD", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MIT", "MPL-2.0"]
    head = "Copyright (c) 2024 Jane Doe and the authors of the project\n\n"
    rows = [(f"{name}/LICENSE", i, head + (folder / f"{name}.txt").read_text()) for i, name in enumerate(names)]
    rows += [(f"{name}/src/x.py", 100 + i, "code") for i, name in enumerate(names)]
    agpl = (folder / "GPL-3.0.txt").read_text().replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE", 1)
    rows += [("agpl/LICENSE", 50, agpl), ("prose/x", 60, prose(random.Random(2), 900))]
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "path STRING, doc_id BIGINT, text STRING")).collect()}
    for i, name in enumerate(names):
        assert (got[i]["license"], got[i]["license_file"]) == (name, True)
        assert (got[100 + i]["license"], got[100 + i]["inherited_from"]) == (name, name)
    assert got[50]["license"] == "AGPL-3.0" and got[60]["license"] is None


def test_checksums_of_pieces(spark):
    rows = packing.pack(spark.createDataFrame([(1, "a b c")], DOCS), PATH).select("ids", F.crc32("ids").alias("crc")).collect()
    assert all(zlib.crc32(row["ids"]) == row["crc"] for row in rows)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


@pytest.mark.parametrize("text", [" " * 3_000_000 + "end", "a\n" + "\n" * 3_000_000, "1" * 300_000, "x" * 300_000 + " y"])
def test_ids_of_long_runs(text):
    """Where the fast matcher gives up the tokenizer's own ids are taken."""
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encoder(path).encode(text), "<u4").tolist() == want


def test_spans_of_a_text_with_very_many_matches(spark):
    """The work grows with the length of the text, not with its square."""
    n = 100_000
    text = " ".join(f"a{i}@b.org" for i in range(n))
    spans = pii.candidates(spark.createDataFrame([(1, text), (2, "x@y.z 1.2.3.4")], "doc_id BIGINT, text STRING"))
    base = spans.where("base AND kind = 'email'").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("end").alias("end")).collect()
    assert {(r["doc_id"], r["n"], r["end"]) for r in base} == {(1, n, len(text)), (2, 1, 5)}
    assert pii._fresh(spans).where("kind = 'email'").count() == 0
