"""Operators of the training-data package against brute force, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, components, decontaminate, media, minhash, packing, pii, quality, sharding, suffix, urls

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i}" for i in range(30000))
BASE = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what the hurry is all about today " * 3


def docs_of(spark, texts, **more):
    rows = [(i, t) for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("text_", "id", "bucket", "h", "w", "p", "n", "spans", "label", "block", "sha"):
        df = df.withColumn(name, F.lit("clash"))
    return df


TEXTS = [
    (0, BASE),
    (1, BASE),
    (2, BASE.replace("hurry", "worry", 1)),
    (3, ""),
    (4, None),
    (5, " \n\t "),
    (6, "Mail bob.smith@example.com or call +1 (212) 555-0199, card 4111 1111 1111 1111, host 10.0.0.255 and 10.0.0.256."),
    (7, LONG),
    (8, "short"),
    (8, "short"),
    (None, "no id at all"),
    (9, "naïve café 東京 <|endoftext|> a  b\n\n c"),
    (10, LONG + " tail"),
]


@pytest.fixture
def docs(spark):
    return docs_of(spark, TEXTS)


@pytest.fixture
def empty(spark):
    return docs_of(spark, [])


def test_packing_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(TOKENIZER)
    got = [r.asDict() for r in packing.pack_documents(docs, TOKENIZER).collect()]
    by = defaultdict(list)
    for r in got:
        assert len(r["token_ids"]) == 4 * r["length"]
        by[r["doc_id"]].append(r)
    for doc, text in TEXTS:
        want = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        parts = sorted(by[doc], key=lambda r: r["start"])
        if doc == 8:
            assert len(parts) == 2
            continue
        assert b"".join(p["token_ids"] for p in parts) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append(r)
    for pieces in seqs.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    assert packing.pack_documents(empty, TOKENIZER).count() == 0


def test_ids_are_those_of_the_vocabulary():
    """Random texts of words, spaces, marks, scripts and spelled added tokens, against ``tokenizers``."""
    from tokenizers import Tokenizer

    tok, rng = Tokenizer.from_file(TOKENIZER), np.random.default_rng(2)
    with open(TOKENIZER, "rb") as f:
        coder = packing.encoder(f.read())
    bits = ["a", " the", "  ", "\n", "\t", "1234", "don't", "'LL", "é", "ß", "東京", "🙂", "\u200d", "\x00", "\xa0", "<|endoftext|>", "<|endof", "text|>", "|", "_", "Ω", "İ", "\u0301", "!?", "...", " ", "x" * 30]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.integers(0, 30)))
        assert np.frombuffer(packing.token_ids(coder, text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_packer_takes_the_level_of_least_squares():
    rng = np.random.default_rng(0)
    p = packing.Packer(50, 0)
    for _ in range(400):
        size = int(rng.integers(1, 50))
        level = p.level_for(size)
        cost = {}
        for h in range(0, 50 - size + 1):
            if h == 0 or p._open[h] > 0:
                n = p._open.copy()
                if h:
                    n[h] -= 1
                if h + size < 50:
                    n[h + size] += 1
                cost[h] = int((n[1:50] ** 2).sum())
        best = min(cost.values())
        assert level == max(h for h, c in cost.items() if c == best)
        list(p.add(1, b"\0\0\0\0" * size, size))
        assert [len(x) for x in p._at] == [int(x) for x in p._open[:50]]


def test_media(spark, docs, empty):
    got = {r["doc_id"]: r for r in media.digest_media(media.media_documents(docs)).collect()}
    for doc, text in TEXTS:
        raw = (text or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        r = got[doc]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert media.media_documents(empty).count() == 0
    assert {r["feature"].split(";")[0] for r in got.values()} <= {"type=wav", "type=bmp", "type=png"}


def test_sniffing_carves_and_corrects():
    payload = bytes(range(256)) * 9
    files = {k: media.store(payload, k) for k in ("wav", "bmp", "png")}
    for k, blob in files.items():
        assert media.sniff(blob)[:2] == (k, len(blob)) and media.load(blob, k) == payload
    gif = b"GIF89a\x01\0\x01\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0;"
    jpeg = b"\xff\xd8\xff\xe0\0\x04ab\xff\xda\0\x02\x11\xff\0\x22\xff\xd9"
    gz = __import__("gzip").compress(b"x" * 1000)
    blob = b"BM and RIFF in text " + files["png"] + b"--" + gif + b"JUNK" + jpeg + gz + files["wav"][:-1]
    kind, _, found = media.sniff(blob)
    assert kind == "unknown"
    assert [(k, n) for k, _, n in found] == [("png", len(files["png"])), ("gif", len(gif)), ("jpeg", len(jpeg)), ("gzip", len(gz))]
    assert all(blob[o : o + n] in (files["png"], gif, jpeg, gz) for _, o, n in found)
    assert media.sniff(None) == ("unknown", 0, [])
    broken = bytearray(files["png"])
    broken[40] ^= 1
    assert media.sniff(bytes(broken))[0] == "unknown"


def test_sniffing_finds_what_a_plain_scan_finds():
    """Every validator tried at every offset, without an automaton."""
    rng = np.random.default_rng(8)
    payload = bytes(range(256)) * 9
    gif = b"GIF89a\x01\0\x01\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0;"
    files = [*(media.store(payload, k) for k in ("wav", "bmp", "png")), gif, b"BM", b"RIFF", b"\x1f\x8b\x08", __import__("gzip").compress(payload)]
    for _ in range(60):
        blob = b"".join(files[int(k)][: int(rng.integers(1, 4000))] if rng.random() < 0.3 else files[int(k)] + b"-" * int(rng.integers(0, 5)) for k in rng.integers(0, len(files), 6))
        first, found, past = ("unknown", 0), [], 0
        for at in range(len(blob)):
            for magic, name in media.MAGIC.items():
                if blob.startswith(magic, at) and (at == 0 or at >= past):
                    kind, size = media.CHECKS[name](memoryview(blob)[at:])
                    if size and at:
                        found.append((kind, at, size))
                        past = at + size
                    elif size:
                        first = kind, size
        kind, size, carved = media.sniff(blob)
        assert ((kind, size), carved) == (first, found)


def test_carving_does_not_depend_on_the_container(spark):
    """The same embedded file is found whatever container the text is stored in."""
    texts = [(i, f"{i} GIF89a\x01\0\x01\0\0\0\0,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0; {'end' * i}") for i in range(30)]
    got = media.digest_media(media.media_documents(spark.createDataFrame(texts, "doc_id long, text string"))).collect()
    assert {r["media_type"] for r in got} == {"wav", "bmp", "png"}
    for r in got:
        at = len(str(r["doc_id"])) + 1
        assert r["embedded"] == f"gif:{at}:29" and r["corrected"] == (r["declared_type"] != r["media_type"])


def plain_spans(text):
    """The four kinds by plain patterns."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans_match_the_patterns():
    rng = np.random.default_rng(1)
    bits = ["a@b.c", "@", "x.y-z", "1", "22", "333", ".", "-", " ", "+", "4111111111111111", "10.1.2.3", "é", "(", ")", "%", "_", "@b", ".com", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.integers(0, 25)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_pii(spark, docs, empty):
    got = {r["doc_id"]: r for r in pii.digest_spans(pii.annotate(docs)).collect()}
    r = got[6]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1)
    for doc, text in TEXTS:
        s = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in plain_spans(text or ""))
        assert got[doc]["base_sha256"] == hashlib.sha256(s.encode()).hexdigest() and got[doc]["spans"] == s
    safe = {r["doc_id"]: r["text"] for r in pii.sanitize(docs).collect()}
    assert safe[6].startswith("Mail [EMAIL] or call [PHONE], card [CARD], host [IP] and") and safe[0] == BASE and safe[4] is None
    assert pii.annotate(empty).count() == 0 and pii.sanitize(empty).columns == empty.columns


def test_terms_that_reveal_an_entity(spark):
    told = [(i, f"note {'abcdefghijk'[i]}{'abcdefghijk'[i]}x the Zanzibarian captain wrote from sea@ship.example again {'lmnopqrstuv'[i]}oo") for i in range(5)]
    plain = [(100 + i, f"the note wrote again from here number {i}") for i in range(600)]
    alone = [(900, "the Zanzibarian slept")]
    copies = [(2000 + i, "one unusualword near tom@x.org always") for i in range(20)]
    df = docs_of(spark, [*told, *plain, *alone, *copies])
    terms = {r["term"]: r for r in pii.revealing_terms(df).collect()}
    assert {"zanzibarian", "captain"} <= set(terms) and not {"the", "note", "again", "unusualword"} & set(terms)
    n, n_t, n_te, n_e = len(told) + 600 + 1 + 20, 6, 5, 5
    assert terms["zanzibarian"]["bits"] == pytest.approx(np.log2(n_te * n / (n_t * n_e))) and terms["zanzibarian"]["confidence"] == pytest.approx(5 / 6)
    assert {r["doc_id"]: r["text"] for r in pii.sanitize(df).collect()}[900] == "the [TERM] slept"


def test_terms_of_an_entity_in_many_texts(spark):
    """An entity in a third of all texts has 1.58 bits, whatever the table's size; copies count once."""
    held = [(i, f"number {i} the Zanzibarian captain wrote from sea@ship.example") for i in range(30)]
    plain = [(100 + i, f"the note wrote again from here number {i}") for i in range(60)]
    alone = [(200, "the Zanzibarian slept")]
    chance = [(300 + i, f"number {i} the rareword wrote from sea@ship.example today") for i in range(3)]
    copies = [(1000 + i, "the only copy of sea@ship.example and the captain") for i in range(500)]
    df = docs_of(spark, [*held, *plain, *alone, *chance, *copies])
    terms = {r["term"]: r for r in pii.revealing_terms(df).collect()}
    assert set(terms) == {"zanzibarian", "captain"}
    n, n_e = 30 + 60 + 1 + 3 + 1, 30 + 3 + 1
    assert terms["zanzibarian"]["confidence"] == pytest.approx(30 / 31)
    assert terms["zanzibarian"]["share"] == pytest.approx(np.log2(30 / 31 * n / n_e) / np.log2(n / n_e)) and terms["captain"]["share"] == 1
    safe = {r["doc_id"]: r["text"] for r in pii.sanitize(df).collect()}
    assert safe[200] == "the [TERM] slept" and safe[1000] == "the only copy of [EMAIL] and the "


def test_terms_far_from_a_rare_entity(spark):
    """Two texts are enough, and the distance within them does not matter."""
    far = " and so on with the usual words" * 20
    held = [(i, f"Zanzibarian news {far} sea@ship.example number {'one two'.split()[i]}") for i in range(2)]
    plain = [(100 + i, f"usual news and so on with the words number one two {i}") for i in range(1000)]
    terms = {r["term"] for r in pii.revealing_terms(docs_of(spark, [*held, *plain])).collect()}
    assert terms == {"zanzibarian"}


@pytest.mark.parametrize("size", [1, 2, 200_000])
def test_blocks_of_terms_do_not_change_the_text(spark, monkeypatch, size):
    monkeypatch.setattr(pii, "BLOCK_TERMS", size)
    told = [(i, f"note {'abcdefghijk'[i]}{'abcdefghijk'[i]}x the Zanzibarian captain with an email term wrote from sea@ship.example again") for i in range(5)]
    plain = [(100 + i, f"the note wrote again from here number {i} with an") for i in range(600)]
    alone = [(900, "the Zanzibarian email term slept")]
    safe = {r["doc_id"]: r["text"] for r in pii.sanitize(docs_of(spark, [*told, *plain, *alone])).collect()}
    assert safe[900] == "the [TERM] [TERM] [TERM] slept"
    assert safe[1].endswith("the [TERM]  with an [TERM] [TERM] wrote from [EMAIL] again") and safe[100] == plain[0][1]


def cut(texts, n=100):
    """What is left when every byte of an n-byte string that starts earlier goes."""
    seen, out = set(), {}
    for doc, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if (w := b[p : p + n]) in seen:
                gone[p : p + n] = True
            seen.add(w)
        out[doc] = bytes(np.frombuffer(b, np.uint8)[~gone])
    return out


def test_repeated_strings(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 700)
    monkeypatch.setattr(suffix, "REDUCER_VALUES", 300)
    monkeypatch.setattr(suffix, "RANGE_BYTES", 5000)
    rng = np.random.default_rng(3)
    piece = ["".join(rng.choice(list("ab "), 150)) for _ in range(4)]
    texts = [(i, "".join(rng.choice(piece)[int(rng.integers(0, 60)) :] + "#" * int(rng.integers(0, 3)) for _ in range(3))) for i in range(40)] + [(100, "x" * 1000), (101, "é" * 80), (102, None), (103, "x" * 99), (104, texts_100())]
    got = {r["doc_id"]: r for r in suffix.repeated_strings(docs_of(spark, texts)).collect()}
    want = cut(texts)
    assert {k: bytes(r["kept"]) for k, r in got.items()} == want
    for k, r in got.items():
        assert r["n_removed"] == r["n_bytes"] - len(want[k]) and (r["n_spans"] > 0) == (r["n_removed"] > 0)
    assert suffix.repeated_strings(empty).count() == 0
    assert len({(a - b) % suffix.V for a in suffix.COVER for b in suffix.COVER}) == suffix.V
    x = np.unique(rng.integers(0, 2**63, 500, np.uint64) * np.uint64(2))
    assert (suffix._unpacked(suffix._packed(x)) == x).all()


def texts_100():
    return "x" * 100 + "y" * 120


def test_repeats_in_edge_texts(docs):
    got = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in suffix.repeated_strings(docs).collect()}
    assert got[1, len(BASE)] == len(BASE) and got[4, 0] == 0 and got[10, len(LONG) + 5] > len(LONG) - 10


def brute_components(texts, words):
    sets = {}
    for doc, t in texts:
        w = (t or "").encode().lower().split()
        sets[doc] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("block", [8, 512])
def test_near_duplicates(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = []
    for g in range(6):
        base = list(rng.choice(vocabulary, 60 + 20 * g))
        for _ in range(20):
            t = list(base)
            for _ in range(int(rng.integers(0, 6))):
                t[int(rng.integers(len(t)))] = str(rng.choice(vocabulary))
            texts.append((len(texts) * 3, " ".join(t)))
    texts += [(1000, "One two"), (1001, "one TWO"), (1002, ""), (1003, None), (1004, "É one two three"), (1005, "é one two three")]
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs_of(spark, texts), minhash.Params(words=4)).collect()}
    assert {k: (r["n_shingles"], r["component_id"]) for k, r in got.items()} == brute_components(texts, 4)
    assert all(r["kept"] == (k == r["component_id"]) for k, r in got.items())
    edge = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()]
    assert len(edge) == len(TEXTS) and (None, None, True) in edge and (1, 0, False) in edge and (10, 7, False) in edge and edge.count((8, 8, True)) == 2
    assert minhash.near_duplicates(empty).count() == 0


def test_one_id_with_two_texts(spark):
    """Links are those of the texts, in any order and over any partitions."""
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [(1, one), (1, two), (2, one + " tail"), (3, two + " end"), (3, two + " end"), (None, one), (4, "alone it stands")]
    want = sorted([("1", 57, 1), ("1", 57, 1), ("2", 58, 1), ("3", 58, 1), ("3", 58, 1), ("None", 57, None), ("4", 1, 4)], key=str)
    for k, order in enumerate((rows, rows[::-1], rows[2:] + rows[:2])):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(1 + 3 * k)
        got = minhash.near_duplicates(df, minhash.Params(words=4)).collect()
        assert sorted([(str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in got], key=str) == want
        assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_a_hot_centre_is_split(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PAIRS", 7)
    base = [f"w{i}" for i in range(80)]
    texts = [(i, " ".join([*base, f"tail{i}"])) for i in range(100)]
    got = minhash.near_duplicates(docs_of(spark, texts)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_blocks_of_a_large_component(spark, monkeypatch):
    """The rows dealt into blocks do not grow with the square of a group that is linked, and no link is lost."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    dealt, blocks = [], minhash._blocks
    monkeypatch.setattr(minhash, "_blocks", lambda rows: dealt.append((rows.count(), (out := blocks(rows)).count())) or out)
    base = [f"w{i}" for i in range(80)]
    texts = [(i, " ".join([*base, f"tail{i}"])) for i in range(100)]
    texts += [(200 + i, " ".join([*base[: 50 + i], *(f"x{i}y{k}" for k in range(30 - i))])) for i in range(3)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == brute_components(texts, 5) and len({c for _, c in got.values()}) == 4
    assert dealt and sum(n for n, _ in dealt) > 100 and sum(x for _, x in dealt) <= 2 * sum(n for n, _ in dealt)


def test_each_pair_of_components_meets_in_one_block(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    label = [0] * 10 + [10] * 4 + list(range(14, 20)) + [20] * 5 + [25] * 5 + [30, 31] + [32] * 4
    bucket = [64] * 20 + [128] * 10 + [192] * 2 + [256] * 4
    rows = spark.createDataFrame([(b, i, k, 9, bytes(512)) for i, (b, k) in enumerate(zip(bucket, label, strict=True))], "bucket long, id long, label long, size long, minima binary")
    met = defaultdict(int)
    for t in minhash._blocks(minhash._mixed(rows)).toPandas().groupby(["bucket", "low", "high"]):
        block = minhash.pa.Table.from_pandas(t[1], preserve_index=False)
        ids = block.column("id").to_pylist()
        for x, y, _ in minhash._across(block, minhash.Params()):
            for j in y:
                met[tuple(sorted((ids[x], ids[j])))] += 1
    assert met == {(i, j): 1 for i, j in itertools.combinations(range(len(label)), 2) if bucket[i] == bucket[j] and label[i] != label[j]}


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5), (None, 3)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_components_by_either_way(spark, monkeypatch, most):
    """Star steps and one task give the same; few links take few jobs."""
    monkeypatch.setattr(components, "LINKS", most)
    rng = np.random.default_rng(6)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] * 2 + [(999, i) for i in range(900, 950)] + [(i, i - 1) for i in rng.permutation(range(2000, 2080)).tolist()] + [(7, 7), (None, 3), (3, None)]
    root = {x: x for p in pairs if None not in p and p[0] != p[1] for x in p}
    for _ in root:
        for a, b in pairs:
            if a in root and b in root:
                root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    spark.sparkContext.setJobGroup(f"components {most}", "")
    try:
        got = [(r["id"], r["component"]) for r in components.components(df).collect()]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(got) == sorted(root.items())
    assert not most or len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components {most}")) <= 6


def test_decontamination(spark, docs, empty, monkeypatch):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    words = item.split()
    swapped = [w if i not in (5, 11) else "other" for i, w in enumerate(words)]
    texts = [(1, f"before it, {item.upper()}. after"), (2, " ".join(["lead", *swapped, "end"])), (3, " ".join(words[:7])), (4, " ".join(words[::-1])), (5, None), (6, "x " * 500 + item), (6, item), (None, item)]
    items = spark.createDataFrame([(10, item), (11, None), (12, "too short"), (None, item)], "item_id long, text string")
    want = [(1, 10, 16, 16, 12), (2, 10, 16, 14, 10), (6, 10, 16, 16, 12)]
    for size in (decontaminate.BLOCK_SEEDS, 7):
        monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", size)
        assert sorted(tuple(r) for r in decontaminate.overlaps(docs_of(spark, texts), items).collect()) == want
    left = sorted(str(r["doc_id"]) for r in decontaminate.decontaminate(docs_of(spark, texts), items).collect())
    assert left == ["3", "4", "5"]
    assert decontaminate.overlaps(empty, items).count() == 0 and decontaminate.overlaps(docs, items.limit(0)).count() == 0
    plan = decontaminate._seeds(docs, "doc_id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_overlaps(texts, items, window=12, percent=80):
    """All diagonals of all pairs, without seeds."""
    out = {}
    for d, text in texts:
        for i, item in items:
            w, g = text.split(), item.split()
            n = min(window, len(g))
            for shift in range(-len(g), len(w)):
                same = [0 <= shift + q < len(w) and w[shift + q] == x for q, x in enumerate(g)]
                best = max(sum(same[s : s + n]) for s in range(len(g) - n + 1))
                if 100 * best >= percent * n:
                    old = out.get((d, i), (0, 0, 0))
                    out[d, i] = (len(g), max(old[1], sum(same)), max(old[2], best))
    return out


def test_masks_leave_no_placement_out():
    for window in range(1, 15):
        for percent in (50, 80, 100):
            differ = window - -(-percent * window // 100)
            for lost in itertools.combinations(range(window), differ):
                assert any(not {p + x for x in m} & set(lost) for m in decontaminate.masks(window, differ) for p in range(window - m[-1])), (window, differ, lost)


def test_decontamination_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(11)
    items = [(m, " ".join(f"i{m}w{q}" for q in range(m))) for m in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 16, 30)]
    texts = []
    for m, item in items:
        for lost in itertools.combinations(range(min(m, 12)), 2 if m > 4 else 1):
            words = item.split()
            for x in lost:
                words[x] = "other"
            texts.append(" ".join(["lead", *words, "end"] if rng.random() < 0.5 else words))
        texts += [item, "lead " + item, " ".join(item.split()[1:]), " ".join(item.split()[:-1]), " ".join("other" if q % 8 in (3, 4) else x for q, x in enumerate(item.split()))]
        texts += [" ".join("other" if rng.random() < 0.2 else x for x in item.split()) for _ in range(10)]
    texts = list(enumerate(texts))
    got = decontaminate.overlaps(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): (r["item_words"], r["equal_words"], r["best_window"]) for r in got} == brute_overlaps(texts, items)


@pytest.mark.parametrize("piece", [1, 7, 1024])
def test_seeds_do_not_depend_on_pieces(spark, monkeypatch, piece):
    item = [f"q{i}" for i in range(12)]
    docs = {k: [f"w{k}x{i}" for i in range(k)] + item + ["z"] * 30 for k in (0, 1, 6, 7, 13, 1012, 1018, 1023, 1024, 2047)}
    docs |= {5000: item[:11], 5001: [], 5002: item}
    docs = {k: " ".join(v) for k, v in docs.items()} | {5003: None}
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    frame = docs_of(spark, docs.items())
    seeds = decontaminate._seeds(frame, "doc_id", widths=[12]).groupBy("doc_id").count().collect()
    spans = [m[-1] + 1 for m in decontaminate.masks(12, 2)]
    assert {r[0]: r[1] for r in seeds} == {k: n for k, v in docs.items() if (n := sum(max(len((v or "").split()) - x + 1, 0) for x in spans))}
    got = {r["doc_id"]: r["equal_words"] for r in decontaminate.overlaps(frame, items).collect()}
    assert got == {k: 11 if k == 5000 else 12 for k in docs if k not in (5001, 5003)}


def test_chat(spark, monkeypatch):
    t = lambda c, *turns: [(c, i, "user" if i % 2 == 0 else "assistant", x) for i, x in enumerate(turns)]
    rows = [*t(1, "hi"), *t(2, "hi", "yo"), *t(3, "hi", "yo", "bye"), *t(4, "hi", "no"), *t(5, "hi", "no"), *t(6, "alone"), *t(7, *[f"m{i}" for i in range(30)]), *t(8, *[f"m{i}" for i in range(20)])]
    rows += [(9, None, None, None), (9, 0, "user", ""), (None, 0, "user", "lost"), (6, 0, "user", "alone")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("chunk", F.lit("clash")).withColumn("n", F.lit("clash"))
    for size in (1024, 4):
        monkeypatch.setattr(chat, "CHUNK", size)
        got = chat.render(df).collect()
        assert sorted({r["conv_id"] for r in got}) == [3, 4, 6, 7, 9]
        text = {c: "".join(r["rendered"] for r in sorted(got, key=lambda r: r["part"]) if r["conv_id"] == c) for c in (3, 6, 7, 9)}
        assert text[3] == "<|user|>\nhi<|end|>\n<|assistant|>\nyo<|end|>\n<|user|>\nbye<|end|>\n" and text[6] == "<|user|>\nalone<|end|>\n"
        assert text[7].count("<|end|>") == 30 and text[9] == "<|unknown|>\n<|end|>\n<|user|>\n<|end|>\n"
    assert chat.render(df.limit(0)).count() == 0


def test_urls(spark):
    import datetime as dt

    listed = spark.createDataFrame([("bad.org", "spam", dt.date(2024, 1, 10), "add"), ("bad.org", "spam", dt.date(2024, 2, 1), "remove"), ("bad.org", "spam", dt.date(2024, 1, 10), "add"), ("x.bad.org", "adult", dt.date(2024, 1, 1), "add"), (None, "spam", dt.date(2024, 1, 1), "add")], "domain string, category string, day date, action string")
    rows = [(1, "http://bad.org/a", dt.date(2024, 1, 9)), (2, "http://www.BAD.org:80/a", dt.date(2024, 1, 10)), (3, "https://u@bad.org", dt.date(2024, 2, 1)), (4, "http://y.x.bad.org/", dt.date(2024, 1, 20)), (5, "http://notbad.org/", dt.date(2024, 1, 20)), (6, None, dt.date(2024, 1, 20)), (7, "nonsense", None), (2, "http://www.BAD.org:80/a", dt.date(2024, 1, 10))]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at date").withColumn("domain", F.lit("clash"))
    got = {r["page_id"]: (r["blocked"], r["matched_domain"], r["category"], r["n_captures"]) for r in urls.judge(captures, listed).collect()}
    no = (False, None, None, 1)
    assert got == {1: no, 2: (True, "bad.org", "spam", 2), 3: no, 4: (True, "x.bad.org", "adult", 1), 5: no, 6: no, 7: no}
    assert urls.judge(captures.limit(0), listed).count() == 0 and urls.judge(captures, listed.limit(0)).where("blocked").count() == 0


def test_sharding(spark, docs, empty):
    rng = np.random.default_rng(6)
    texts = [(i, "x" * int(rng.integers(0, 900))) for i in range(300)] + [(500, "y" * 5000), (501, None)] + [(700, "z" * 300)] * 40
    got = sharding.shards(docs_of(spark, texts), limit=2000).collect()
    assert len(got) == len(texts)
    size = defaultdict(int)
    for r in got:
        size[r["shard_id"]] += r["n_bytes"]
    for r in got:
        assert r["shard_bytes"] == size[r["shard_id"]] and (r["shard_bytes"] <= 2000 or r["shard_rows"] == 1)
    names = sorted(s.split("-")[0] for s in size)
    assert not any(b != a and b.startswith(a) for a, b in zip(names, names[1:], strict=False))
    assert {r["shard_id"] for r in sharding.shards(docs).collect()} == {""}
    assert sharding.shards(empty).count() == 0


@pytest.mark.parametrize("limit", [100])
def test_written_shards_hold_each_row_once(spark, tmp_path, limit):
    rng = np.random.default_rng(9)
    texts = [(i, "x" * int(rng.integers(0, 300))) for i in range(60)] + [(7, "another text of id 7"), (7, "another text of id 7"), (None, "none"), (200, None)] + [(300, "z" * 50)] * 41
    df = docs_of(spark, texts)
    contents = []
    for k, layout in enumerate((df, df.coalesce(1), df.repartition(7))):
        sharding.write_shards(layout, f"file://{tmp_path}/{k}", limit)
        back = spark.read.parquet(f"file://{tmp_path}/{k}")
        rows = [(r["doc_id"], r["text"], r["shard"]) for r in back.collect()]
        assert sorted(map(str, ((d, t) for d, t, _ in rows))) == sorted(map(str, texts)) and set(df.columns) < set(back.columns)
        size = defaultdict(list)
        for _, t, s in rows:
            assert isinstance(s, str) and s.startswith("s-")
            size[s].append(len(t or ""))
        assert all(sum(x) <= limit or len(x) == 1 for x in size.values())
        contents.append(sorted(map(str, rows)))
        told = sharding.shards(layout, limit).collect()
        assert sorted((str(r["doc_id"]), "s-" + r["shard_id"]) for r in told) == sorted((str(d), s) for d, _, s in rows)
    assert contents[0] == contents[1] == contents[2]


def test_quality_matches_a_plain_fit(spark):
    """Coefficients, raw scores and calibration against numpy on all labelled rows at once."""
    rng = np.random.default_rng(12)
    texts = [(i, " ".join(rng.choice(["one", "two", "THREE", "4", "five!", "a", "longerword"], int(rng.integers(1, 60))))) for i in range(500)]
    labels = [(i, int(len(t) % 3 > 0), 0) for i, t in texts]
    stats = quality.document_statistics(spark.createDataFrame(texts, "doc_id long, text string").repartition(9))
    model = quality.fit(stats, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    part = np.array([zlib.crc32(str(i).encode()) % 5 for i, _ in texts])
    x, y = np.array([quality.statistics(t) for _, t in texts]), np.array([q for _, q, _ in labels], float)
    train = part > 1
    assert np.allclose(model.mean, x[train].mean(axis=0)) and np.allclose(model.scale, np.where(x[train].std(axis=0) > 1e-9, x[train].std(axis=0), 1))
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    design = np.hstack([np.ones((len(z), 1)), z, np.cos(z @ model.weights + model.shift) * np.sqrt(2 / len(model.shift))])
    gram = design[train].T @ design[train]
    beta = np.linalg.solve(gram + 1e-3 * train.sum() / len(gram) * np.eye(len(gram)), design[train].T @ y[train])
    assert np.allclose(model.raw(x), np.clip(design @ beta, 0, 1), atol=1e-6)
    held = part == 1
    bins = np.minimum((model.raw(x[held]) * quality.BINS).astype(int), quality.BINS - 1)
    pool = [[b, [v]] for b, v in sorted(zip(bins, y[held], strict=True), key=lambda r: r[0])]
    merged = []
    for b, v in pool:
        if merged and merged[-1][0][-1] == b:
            merged[-1] = (merged[-1][0] + [b], merged[-1][1] + v)
        else:
            merged.append(([b], v))
        while len(merged) > 1 and np.mean(merged[-2][1]) >= np.mean(merged[-1][1]) and merged[-2][0][-1] != merged[-1][0][0] and not any(c == merged[-1][0][-1] for c, _ in pool[sum(len(m[1]) for m in merged) :]):
            last = merged.pop()
            merged[-1] = (merged[-1][0] + last[0], merged[-1][1] + last[1])
    assert np.allclose(model.values, [np.mean(v) for _, v in merged])


def test_quality(spark, docs, empty):
    rng = np.random.default_rng(7)
    good = [(i, " ".join(rng.choice(["apple", "river", "stone", "walks", "slowly", "the", "a"], 60)) + ".") for i in range(0, 600, 2)]
    bad = [(i, " ".join(f"{w}%%%" for w in rng.choice(["BUY", "NOW", "$$$"], 60))) for i in range(1, 600, 2)]
    df = docs_of(spark, good + bad)
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(600)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_documents(df, labels).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == 1 - r["doc_id"] % 2 for r in got if r["held_out"]]) > 0.98
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted((r["doc_id"], r["score"]) for r in quality.score_documents(df, flipped).collect()) == sorted((r["doc_id"], r["score"]) for r in got)
    assert len(quality.score_documents(docs, labels).collect()) == len(TEXTS)
    assert {r["score"] for r in quality.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_documents(empty, labels).count() == 0
    x, y = quality.pooled(np.array([0.1, 0.2, 0.3, 0.4]), np.array([1.0, 0, 2, 3]), np.array([1.0, 1, 2, 3]))
    assert list(y) == [0.5, 1.0] and (np.diff(x) > 0).all()


def test_pipeline(spark):
    import corpus_pipeline as cp

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    from millrace.llm.common import materialize

    kept = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, kept[-1], d)
        if k < 4:
            out = materialize(out, "test")
            assert out.columns == docs.columns
        kept.append(out)
    score = {r["doc_id"]: r["predicted"] for r in quality.score_documents(docs, spark.read.parquet(f"{d}/labels.parquet")).collect()}
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in kept]
    assert ids[1] == {k for k, v in score.items() if v}
    one = [(r["doc_id"], r["text"]) for r in kept[1].collect()]
    assert ids[2] == {k for k, (_, c) in brute_components(one, 5).items() if k == c}
    assert ids[3] == ids[2] - {r["doc_id"] for r in decontaminate.overlaps(kept[2], spark.read.parquet(f"{d}/benchmark.parquet")).collect()}
    assert ids[4] == ids[3] == ids[5]
    assert all(not plain_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in kept[4].collect())
    pieces = defaultdict(int)
    for r in kept[5].collect():
        pieces[r["doc_id"]] += r["length"]
    with open(TOKENIZER, "rb") as f:
        coder = packing.encoder(f.read())
    assert pieces == {r["doc_id"]: len(packing.token_ids(coder, r["text"])) // 4 + 1 for r in kept[4].collect()}


def test_pipeline_decides_row_by_row(spark, monkeypatch):
    """Null ids and texts, repeated rows, two texts under one id, and columns whose names clash."""
    import corpus_pipeline as cp

    item = " ".join(f"item{i}" for i in range(30))
    good = lambda k: f"{BASE} with its own words {k} " + " ".join(f"{k}w{i}" for i in range(120))
    rows = [(1, good("a")), (1, good("b")), (2, good("a") + " tail"), (None, good("a")), (None, good("c")), (None, good("c")), (3, f"{good('d')} {item}"), (3, good("e")), (None, f"{good('f')} {item}"), (4, None), (5, ""), (None, None)]
    df = docs_of(spark, rows)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, item), (None, "nothing"), (2, None)], "item_id long, text string")
    monkeypatch.setattr(cp, "table", lambda spark, sf_dir, name: {"labels": labels, "benchmark": benchmark}[name])
    show = lambda f: sorted(map(str, ((r["doc_id"], r["text"]) for r in f.collect())))
    kept = cp.keep_quality(spark, df, "")
    assert show(kept) == sorted(map(str, rows)) and kept.columns == df.columns
    kept = cp.drop_near_duplicates(spark, df, "")
    want = [(1, good("a")), (1, good("b")), (None, good("c")), (3, f"{good('d')} {item}"), (3, good("e")), (None, f"{good('f')} {item}"), (4, None), (5, ""), (None, None)]
    assert show(kept) == sorted(map(str, want)) and kept.columns == df.columns
    kept = cp.drop_benchmark(spark, kept, "")
    assert show(kept) == sorted(map(str, [w for w in want if not w[1] or item not in w[1]])) and kept.columns == df.columns
    for stage in (cp.keep_quality, cp.drop_near_duplicates, cp.drop_benchmark):
        assert stage(spark, df.limit(0), "").count() == 0


def test_pipeline_deals_a_large_group_once(spark, monkeypatch):
    """One row of a large group of near-duplicates is kept, and rows dealt into blocks do not grow with its square."""
    import corpus_pipeline as cp

    monkeypatch.setattr(minhash, "BLOCK", 8)
    dealt, blocks = [], minhash._blocks
    monkeypatch.setattr(minhash, "_blocks", lambda rows: dealt.append((rows.count(), (out := blocks(rows)).count())) or out)
    base = [f"w{i}" for i in range(80)]
    texts = [(i, " ".join([*base, f"tail{i}"])) for i in range(60)] + [(200, " ".join([*base[:66], *(f"x{k}" for k in range(14))]))]
    kept = cp.drop_near_duplicates(spark, docs_of(spark, texts), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 200]
    assert dealt and sum(n for n, _ in dealt) > 60 and sum(x for _, x in dealt) <= 2 * sum(n for n, _ in dealt)


def test_shared_folder_is_needed_on_a_cluster():
    from types import SimpleNamespace

    from millrace.llm import common

    conf = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: conf))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(cluster)
