"""Operators for training data against brute force, the libraries and exact round trips, on small tables with nulls, empty
and long texts, ties, repeated rows, empty tables and clashing names."""

import ast
import base64
import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sonarloom.llm import best_fit_packing, catalog, hnsw, line_dedup, minhash_dedup, piece_transducer, pseudonyms, quality_rules, sentence_spans, token_counts, warc_zip, word_bpe

SPM, WORD = P.path("piece_bpe_32k.model"), P.path("word_bpe_49k.json")
KIND = "doc_id long, text string, source string, n_tokens string, row string"
BITS = ["a", "the", "The", " ", "  ", "\n", "\n\n", "▁", ".", "...", "é", "É", "ß", "漢", "😀", "<s>", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "1", "²", "\t", "\xa0", "\x1c", "ing", "//", "0x", "क", "́", "\r\n"]


def texts(n=3000, seed=0):
    r = random.Random(seed)
    return ["".join(r.choices(BITS, k=r.randint(0, 10))) for _ in range(n)]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in rows], KIND)


ODD = [(1, None, "s1"), (2, "", "s2"), (3, "  \n ", None), (4, "one", "s1"), (5, "one", "s1"), (5, "one", "s1"), (None, "one two", "s3"), (6, "word " * 30000, "s1")]


@pytest.fixture(scope="module")
def spm():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=SPM)


@pytest.fixture(scope="module")
def hf():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD)


def real(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(name, spark, sf, duck, same):
    same(catalog.QUERIES[name](spark, sf), duck.sql(catalog.SQL[name]))


def test_every_operator_has_its_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalog.QUERIES) == list(range(1, 11))


def test_token_counts(spark, sf, spm):
    assert token_counts.SafeUnits(SPM).counts(texts()) == [len(spm.encode(t)) for t in texts()]
    got = token_counts.token_counts(docs(spark, ODD), SPM, limit=100).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted((i or 0, len((t or "").encode()), n := len(spm.encode(t or "")), n > 100) for i, t, _ in ODD)
    assert token_counts.token_counts(docs(spark, []), SPM).count() == 0
    want = {i: len(spm.encode(t or "")) for i, t in real(spark, sf).items()}
    assert {r["doc_id"]: r["n_tokens"] for r in catalog.QUERIES["op1_token_counts"](spark, sf).collect()} == want


def test_word_bpe(hf):
    b, some = word_bpe.WordBpe(WORD, 500), [*texts(), None]
    assert b.quick
    want = [hf.encode(t or "", add_special_tokens=False).ids for t in some]
    assert [i.tolist() for i in b.batch(pa.array(some, pa.string()))] == want
    assert [np.frombuffer(b.ids(t or ""), "<u4").tolist() for t in some] == want


def check_packing(rows, want):
    """rows: pieces; want: doc_id -> list of its rows' ids."""
    spans, left = defaultdict(list), defaultdict(list)
    for r in rows:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
        left[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for s in spans.values():
        end = 0
        for at, n in sorted(s):
            assert at == end
            end += n
        assert end <= 2048
    for i, all_ids in want.items():
        pieces = [(k, a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes())) for ids in all_ids for k, a in enumerate(range(0, len(ids), 2048))]
        assert sorted(left[i]) == sorted(pieces)
    return len(spans)


def best_fit(lengths, capacity=2048):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps.remove(fit)
            gaps.append(fit - n)
    return len(gaps)


def test_packing(spark, sf, hf):
    ids = lambda t: [*hf.encode(t or "", add_special_tokens=False).ids, 0]
    rows = catalog.QUERIES["op2_best_fit_packing"](spark, sf).collect()
    n = check_packing(rows, {i: [ids(t)] for i, t in real(spark, sf).items()})
    assert n == best_fit([r["length"] for r in rows])
    want = defaultdict(list)
    for i, t, _ in ODD:
        want[i].append(ids(t))
    check_packing(best_fit_packing.pack(docs(spark, ODD), WORD).collect(), want)
    assert best_fit_packing.pack(docs(spark, []), WORD).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_sweep_is_best_fit_decreasing(seed):
    r = random.Random(seed)
    lengths = [r.randint(1, r.choice([7, 30, 64])) for _ in range(r.randint(0, 400))]
    used, seats = defaultdict(int), Counter()
    for length, rank, n, first, at, per in best_fit_packing.sweep(dict(Counter(lengths)), 64):
        for k in range(n):
            used[first + k // per] += length
            seats[length] += 1
            assert at + k % per * length + length <= 64
    assert seats == Counter(lengths) and all(v <= 64 for v in used.values()) and len(used) == best_fit(lengths, 64)


@pytest.mark.parametrize("seed", range(3))
def test_supersteps_on_tables(spark, seed):
    """Ranges and tables give what one process gives, a packing that holds every rank once."""
    r = random.Random(seed)
    runs = Counter(min(200, 1 + int(r.expovariate(1 / (10, 40, 90)[seed]))) for _ in range(3000))
    runs[200] += 10**9
    found = best_fit_packing.matched(spark.createDataFrame(list(runs.items()), "length bigint, n bigint"), 200)
    assert (found == best_fit_packing.sweep(dict(runs), 200)).all()
    ends, spans = Counter(), defaultdict(list)
    for length, rank, n, first, at, per in found.tolist():
        assert rank == ends[length] and n % per == 0
        ends[length] += n
        if length < 200:
            for k in range(n // per):
                spans[first + k].append((at, at + per * length))
    assert ends == runs
    for s in map(sorted, spans.values()):
        assert [a for a, _ in s] == [0, *(e for _, e in s[:-1])] and s[-1][1] <= 200
    small = [k for k, n in (runs - Counter({200: runs[200]})).items() for _ in range(n)]
    assert best_fit(small, 200) * 0.999 - 1 <= len(spans) <= best_fit(small, 200) * 1.002 + 1


def test_pseudonyms(spark):
    net = pseudonyms.Feistel(b"k")
    for n in (2, 10, 97, 1000):
        assert sorted(net.once(x, n, "t") for x in range(n)) == list(range(n))
    even = [net.permute(x, 1000, "t", lambda v: v % 2 == 0) for x in range(0, 1000, 2)]
    assert sorted(even) == list(range(0, 1000, 2))
    p = pseudonyms.Pseudonyms(b"k")
    text = "a.b7@mail1.example.com +1 (974) 555-3436 4845168114407329 4845-1681-1440-7329 97.51.17.173 1999-12-31 31.12.1999 123-45-6789 GB82 WEST 1234 5698 7654 32"
    new = p.text(text, found := {})
    assert found == {"email": 1, "phone": 1, "card": 2, "ip": 1, "date": 2, "ssn": 1, "iban": 1}
    old, now = text.split(), new.split()
    assert new == p.text(text, {}) and not set(old[3:10]) & set(now[3:10]) and now[5].replace("-", "") == now[4]
    assert pseudonyms.luhn(now[4][:-1]) == int(now[4][-1]) and pseudonyms.issuer(now[4]) == "4" and now[8] == ".".join(reversed(now[7].split("-")))
    assert pseudonyms.Pseudonyms(b"other").text(text, {}) != new
    for keep in ("1219538112535716", "999.1.1.1", "000-12-3456", "31.02.1999", "version 1.2.3", "12345678901234567890123", "a@b", "+1", ""):
        assert p.text(keep, {}) == keep
    got = pseudonymise_rows(spark, [*ODD, (7, text, "s")])
    assert got[7][0] == pseudonyms.Pseudonyms(pseudonyms.TEST_KEY).text(text, {}) and got[1] == [None] and got[6][0] == "word " * 30000


def test_one_phone_number_has_one_pseudonym():
    p = pseudonyms.Pseudonyms(b"k")
    digits = lambda t: re.sub("[^0-9]", "", t)
    for code, spellings in {
        "1": ["+1 (974) 555-3436", "+19745553436", "+1-974-555-3436", "+1.974.555.3436", "+1 974 555 3436", "(974) 555-3436", "974-555-3436", "974.555.3436"],
        "44": ["+44 20 7946 0958", "+442079460958", "+44 (20) 7946-0958", "+44 (0)20 7946 0958", "+44-20-7946-0958"],
        "351": ["+351 21 123 4567", "+351211234567"],
    }.items():
        out = [p.text(x, {}) for x in spellings]
        assert all(re.sub("[0-9]", "9", x) == re.sub("[0-9]", "9", y) and x != y for x, y in zip(spellings, out))
        own = {digits(x.replace("(0)", ""))[len(code) if x[0] == "+" else 0 :] for x in out}
        assert len(own) == 1 and all(x.startswith(f"+{code}") for x in out if x[0] == "+")
    assert p.text("+1 (974) 555-3436", {}) != p.text("+44 974 555 3436", {})


#: Plain patterns of the kinds that documents hold, each with the part that must change.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+(?=@[A-Za-z0-9.-]+\.[A-Za-z]{2,})",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9.])",
    "phone": r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])",
    "card": r"(?<![0-9+-])[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9-])",
}


def test_pseudonyms_of_documents(spark, sf):
    """The query against plain patterns: the rest of each text stays, values change within their format, equal ones to equal ones."""
    old, kinds = real(spark, sf), Counter()
    rows = catalog.QUERIES["op3_pseudonyms"](spark, sf).collect()
    assert len(rows) == len(old)
    seen: dict = {}
    for r in rows:
        was, now = old[r["doc_id"]], r["text"]
        if not any(r[f"n_{k}"] for k in pseudonyms.KINDS):
            assert now == was
            continue
        assert re.sub("[0-9]", "9", re.sub("[A-Za-z0-9._%+-]+@", "@", now)) == re.sub("[0-9]", "9", re.sub("[A-Za-z0-9._%+-]+@", "@", was)) or r["n_ip"] or r["n_date"] or r["n_iban"]
        for kind, pattern in PLAIN.items():
            a, b = ([m[0] for m in re.finditer(pattern, t)] for t in (was, now))
            if kind == "card":
                a, b = ([x for x in c if sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(re.sub("[^0-9]", "", x)[::-1])) % 10 == 0] for c in (a, b))
            assert len(a) == len(b) or kind in ("ip", "card")
            for x, y in zip(a, b) if len(a) == len(b) else ():
                x, y = (z.lower() if kind == "email" else re.sub("[ -]", "", z) if kind == "card" else z for z in (x, y))
                assert seen.setdefault((kind, x), y) == y
                kinds[kind] += x != y
    assert len({(k, y) for (k, _), y in seen.items()}) == len(seen)
    assert kinds["email"] and kinds["phone"]
    assert pseudonyms.pseudonymise(docs(spark, []), b"k").count() == 0


def pseudonymise_rows(spark, rows):
    out = pseudonyms.pseudonymise(docs(spark, rows), pseudonyms.TEST_KEY)
    assert out.columns == ["doc_id", "text", "source", "n_tokens", "row"]
    got = defaultdict(list)
    for r in out.collect():
        got[r["doc_id"]].append(r["text"])
    return got


class Bytes(io.BytesIO):
    def read_at(self, n, at):
        self.seek(at)
        return self.read(n)


@pytest.mark.parametrize("large", [False, True])
def test_zip_ranges(large):
    rows = [warc_zip.record(k, f"http://x/{k}\r\n", b"p" * k * 100, warc_zip.digest_of(b"p" * k * 100), 9, k % 3 == 0) for k in range(50)]
    f = Bytes()
    warc_zip.write_zip(f, rows, zip64=large)
    size = len(f.getvalue())
    got = [x for a, n in warc_zip.ranges(f, size, 500) for x in warc_zip.records(f.read_at(n, a))]
    assert len(got) == 50 and all(len(p) == (0 if k % 3 == 0 else 100 * k) and h["http-length"] == str(100 * k) for k, (h, p) in enumerate(got))
    with pytest.raises(ValueError):
        warc_zip.directory(Bytes(b"no zip" * 50), 300)


def test_zip_of_others():
    """Several archive members, gzip and plain, other members beside them, and one index as gzip."""
    import gzip
    import json
    import zipfile

    rows = [warc_zip.record(k, f"http://x/{k}", b"p" * k, warc_zip.digest_of(b"p" * k), None, False) for k in range(12)]
    files = {"a.warc.gz": rows[:5], "b.warc.gz": rows[5:9], "c.warc": [gzip.decompress(r) for r in rows[9:]]}
    lines = []
    for name, some in files.items():
        at = 0
        for r in some:
            lines.append(f"key 2020 {json.dumps({'filename': name, 'offset': at, 'length': len(r)})}")
            at += len(r)

    def pack(index):
        f = Bytes()
        with zipfile.ZipFile(f, "w", zipfile.ZIP_STORED) as z:
            z.writestr("datapackage.json", "{}")
            for name, some in files.items():
                z.writestr(f"archive/{name}", b"".join(some))
            z.writestr("indexes/index.cdx.gz", gzip.compress("\n".join(["!meta {}", *index]).encode()))
        return f, len(f.getvalue())

    f, size = pack(lines[::-1])
    got = [h["WARC-Target-URI"] for a, n in warc_zip.ranges(f, size, 700) for h, p in warc_zip.records(f.read_at(n, a)) if warc_zip.digest_of(p) == h["WARC-Payload-Digest"][5:]]
    assert sorted(got) == sorted(f"http://x/{k}" for k in range(12))
    with pytest.raises(ValueError):
        list(warc_zip.ranges(*pack(lines[:9])))


def test_zip64_end_record():
    """A directory whose end record says that its numbers stand in the ZIP64 one."""
    f = Bytes()
    warc_zip.write_zip(f, [warc_zip.record(1, None, b"x", warc_zip.digest_of(b"x"), None, False)])
    data = bytearray(f.getvalue())
    end = data.rfind(b"PK\x05\x06")
    count, size, start = (int.from_bytes(data[end + a : end + b], "little") for a, b in ((10, 12), (12, 16), (16, 20)))
    import struct

    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, size, start)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1)
    tail = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    g = Bytes(bytes(data[:end]) + end64 + locator + tail)
    assert warc_zip.directory(g, len(g.getvalue())) == warc_zip.directory(f, len(f.getvalue()))


def test_warc(spark, sf):
    def check(pages, got):
        best = {}
        for i, _, h in pages:
            best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
        want = []
        for i, _, h in pages:
            b = (h or "").encode()
            again = best[h or ""] != (-1 if i is None else i)
            want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", best[h or ""] if again else None))
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)

    check([tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()], catalog.QUERIES["op4_warc"](spark, sf).collect())
    odd = [(1, None, None), (2, "u\r\nWARC-Type: x", ""), (3, "u", "é" * 100000), (4, "u", "é" * 100000), (None, "u", "é" * 100000), (5, "é", "\r\n\r\n"), (5, "é", "\r\n\r\n")]
    for rows in (odd, []):
        folder = warc_zip.workspace.new_folder(spark, "warc")
        made = warc_zip.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, archive_bytes=300)
        out = warc_zip.read_archives(made, folder, payloads=True)
        check(rows, out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
        assert all(len(r["payload"]) == r["payload_bytes"] for r in out.where("record_type = 'response'").collect())


WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def near_truth(rows, n):
    sets = defaultdict(list)
    for i, t in rows:
        w = WORDS.findall((t or "").translate(LOWER))
        sets[i].append(frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset())
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    flat = [(i, s) for i, l in sets.items() for s in l if i is not None and s]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[:k]:
            if min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sorted(str((i, len(s), root(i), i is None or root(i) == i)) for i, l in sets.items() for s in l)


def test_minhash(spark, sf):
    got = catalog.QUERIES["op5_minhash_dedup"](spark, sf).collect()
    assert sorted(str(tuple(r)) for r in got) == near_truth(real(spark, sf).items(), 2)
    r = random.Random(1)
    base = [str(r.randint(0, 10**6)) for _ in range(120)]
    chain = []
    for k in range(40):
        base = base.copy()
        for _ in range(3):
            base[r.randrange(120)] = f"n{r.randint(0, 10**6)}"
        chain.append((100 + k, " ".join(base), "s"))
    rows = [*ODD, *chain, (7, "ONE", "s"), (8, "one two", "s"), (100, "one two", "s")]
    got = minhash_dedup.near_duplicates(docs(spark, rows), words=2).collect()
    assert sorted(str(tuple(x)) for x in got) == near_truth([(i, t) for i, t, _ in rows], 2)
    kept = minhash_dedup.keep_one(docs(spark, ODD))
    assert kept.columns == ["doc_id", "text", "source", "n_tokens", "row"] and kept.where("doc_id is null").count() == 1
    assert minhash_dedup.near_duplicates(docs(spark, [])).count() == 0


def test_links_in_a_bucket_that_no_centre_joins(spark):
    """Every document falls into one bucket; most have no link, so that centres find none."""
    r = random.Random(4)
    rows = [(i, " ".join(str(r.randint(0, 10**9)) for _ in range(40)), "s") for i in range(60)]
    rows += [(100 + i, f"{t} more", "s") for i, t, _ in rows[20:23]]
    members = spark.createDataFrame([(7, i) for i, _, _ in rows], "band bigint, rep bigint")
    sets = spark.createDataFrame([(i, h.tobytes()) for (i, _, _), h in zip(rows, minhash_dedup.Shingles(2).sets(pa.array([t for _, t, _ in rows])))], "doc bigint, hashes binary")
    got = {x["node"]: x["root"] for x in minhash_dedup._components(members, sets, 80).collect()}
    assert got == {20: 20, 120: 20, 21: 21, 121: 21, 22: 22, 122: 22}


def test_prefix_pairs_lose_no_link(spark):
    """Copies with edits of one template and chains of small edits: all linked pairs are candidates, and few others are."""
    r = random.Random(11)
    template, rows = [f"t{k}" for k in range(120)], []
    for i in range(150):
        words = template[: r.randint(90, 120)]
        for _ in range(r.choice([1, 4, 14, 30])):
            words[r.randrange(len(words))] = f"x{r.randint(0, 10**6)}"
        rows.append((i, " ".join(words)))
    base = [f"c{k}" for k in range(80)]
    for i in range(150, 260):
        base[r.randrange(80)] = f"n{r.randint(0, 10**6)}"
        rows.append((i, " ".join(base)))
    sets = list(minhash_dedup.Shingles(2).sets(pa.array([t for _, t in rows])))
    near = lambda i, j: 100 * (c := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (len(sets[i]) + len(sets[j]) - c)
    want = {(i, j) for j in range(len(rows)) for i in range(j) if near(i, j) and i % 7 != j % 7}
    table = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "doc bigint, hashes binary")
    docs_ = spark.createDataFrame([(i, i % 7) for i, _ in rows], "rep bigint, own bigint")
    found = minhash_dedup.prefix_pairs(docs_, table, 80)
    got = {tuple(sorted((x["a"], x["b"]))) for x in found.collect()}
    assert want <= got and len(want) > 500 and len(got) < 0.4 * len(rows) ** 2 / 2
    linked = {tuple(sorted((x["a"], x["b"]))) for x in minhash_dedup.links(found, table, 80).collect()}
    assert linked == want


def test_permutations_are_permutations():
    x = np.arange(1 << 16, dtype=np.uint32)
    assert len(np.unique(minhash_dedup._scatter(x))) == len(np.unique(minhash_dedup._rank(x.copy()))) == 1 << 16
    h = np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64)
    a, b = minhash_dedup.signature(h[:4500]), minhash_dedup.signature(h[500:])
    assert abs((a == b).mean() - 0.8) < 0.13 and (a == minhash_dedup.signature(h[:4500][::-1].copy())).all()


def plain_parts(t):
    """Sentences, and their parts by the least hash of every twelve words, by plain loops: lists of words."""
    import xxhash

    out, words = [], [(w, white) for w, white in re.findall(r"(\S+)(\s*)", t or "")]
    while words:
        n = next((k for k, (w, white) in enumerate(words, 1) if re.search("[.!?][\"')\\]}»”’]*$", w) or "\n" in white), len(words))
        sentence, words = [w for w, _ in words[:n]], words[n:]
        h = [xxhash.xxh3_64_intdigest(w) >> 1 for w in sentence]
        cut = {0, n}
        for k in range(n - 11):
            cut.add(max(range(k, k + 12), key=lambda i: (-h[i], i)))
        cut = sorted(cut)
        out += [sentence[a:z] for a, z in zip(cut, cut[1:])]
    return out


def plain_spans(rows, run=3):
    """Repeats found by comparing the words of runs: what is left of each document, and how many parts went."""
    seen, parts = defaultdict(list), {i: plain_parts(t) for i, t in rows}
    for i, some in sorted(parts.items()):
        for a in range(len(some) - run + 1):
            seen[" ".join(sum(some[a : a + run], []))].append((i, a))
    gone = defaultdict(set)
    for where in seen.values():
        for i, a in where[1:]:
            gone[i].update(range(a, a + run))
    return {i: (sum((p for k, p in enumerate(some) if k not in gone[i]), []), len(gone[i])) for i, some in parts.items()}


def test_sentence_spans(spark, sf):
    rows = sorted(real(spark, sf).items())
    want = plain_spans(rows)
    got = {r["doc_id"]: r for r in catalog.QUERIES["op6_sentence_spans"](spark, sf).collect()}
    assert {i: ((r["text"] or "").split(), r["n_removed"]) for i, r in got.items()} == want and any(n for _, n in want.values())
    assert all(r["n_units"] == len(plain_parts(t)) and (r["n_removed"] or r["text"] == t) for r, t in ((got[i], t) for i, t in rows))
    r = random.Random(5)
    say = lambda n: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(n))
    for shape in ((51,), (10, 45), (20, 20, 15), (3,) * 20, (6, 6, 6, 5)):
        passage = " ".join(f"{say(n)}." for n in shape)
        a, b = f"{say(30)}. {passage} {say(7)}. {say(9)}", f" {say(4)}!\n{passage}\n{say(40)}."
        out = {x["doc_id"]: x["text"] for x in sentence_spans.remove_repeats(docs(spark, [(1, a, "s"), (2, b, "s"), *[(i + 10 if i else i, t, s) for i, t, s in ODD]])).collect()}
        assert out[1] == a and not set(passage.replace(".", "").split()) & set(out[2].replace(".", "").split()) and out[2][0] == " "
        assert set(b.split()) - set(passage.split()) <= set(out[2].split()) and out[11] is None and out[12] == "" and out[13] == "  \n "
    assert sentence_spans.remove_repeats(docs(spark, [])).count() == 0


def test_sentence_spans_inside_a_sentence(spark):
    """A passage without full stops is found wherever it stands in a sentence; only parts of its edges stay."""
    r = random.Random(8)
    say = lambda n: [f"w{r.randint(0, 10**6)}" for _ in range(n)]
    for _ in range(3):
        passage = say(51)
        rows = [(k, " ".join([*say(k), *passage, *say(r.randint(1, 12))]) + ".", "s") for k in range(13)]
        out = {x["doc_id"]: x["text"].split() for x in sentence_spans.remove_repeats(docs(spark, rows)).collect()}
        assert out[0] == rows[0][1].split()
        for k, t, _ in rows[1:]:
            assert [w for w in out[k] if w not in passage] == [w for w in t.split() if w not in passage]
            left = [w for w in passage if w in out[k]]
            # 11 words at the start and 12 at the end at most.
            assert len(left) <= 23 and not set(passage[11:39]) & set(left)


def test_sentence_spans_long_runs():
    """Time grows with the text: dots, spaces and one long word."""
    parts = sentence_spans.Parts()
    for t in ("." * 200_000 + " x", " " * 200_000 + "x", "a" * 1_000_000, "a " * 300_000):
        parts.cut([t, None, "b c."])
        assert parts.without(0, t, set()) == t and np.diff(parts.first)[1:].tolist() == [0, 1]


def test_line_dedup_edges(spark):
    rows = [(k, f"own {k}\nshared\n\nshared", f"s{k % 12}") for k in range(12)] + [(20, None, None), (21, "shared", None), (None, "shared\nx", "s1"), (22, "only\nhere", "s1"), (0, "shared\nagain", "s3")]
    out = line_dedup.dedup_lines(docs(spark, rows), min_sites=12, counts=True)
    got = Counter((r["doc_id"], r["text"], r["n_removed"]) for r in out.collect())
    want = Counter([(0, "own 0\nshared\n\nshared", 0), *((k, f"own {k}\n", 2) for k in range(1, 12)), (20, None, 0), (21, "", 1), (None, "x", 1), (22, "only\nhere", 0), (0, "shared\nagain", 0)])
    assert got == want
    assert line_dedup.dedup_lines(docs(spark, rows), min_sites=14).where("text like '%shared%'").count() == 15
    assert line_dedup.dedup_lines(docs(spark, [])).columns == ["doc_id", "text", "source", "n_tokens", "row"]


def test_transducer(spark, sf, spm):
    t = piece_transducer.Transducer(SPM, 1000)
    for x in texts(4000, 3):
        ids = np.frombuffer(t.encode(x), "<u4").tolist()
        assert ids == spm.encode(x) and t.decode(ids) == x.replace("▁", " ")
    want = {i: zlib.crc32(np.array(spm.encode(x or ""), "<u4").tobytes()) for i, x in real(spark, sf).items()}
    got = catalog.QUERIES["op8_piece_transducer"](spark, sf).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in got} == want and all(r["decoded"] for r in got)
    coded = piece_transducer.encode(docs(spark, ODD), SPM)
    assert sorted(str(r["text"]) for r in piece_transducer.decode(coded, SPM).collect()) == sorted(str(x) for _, x, _ in ODD)
    assert piece_transducer.encode(docs(spark, []), SPM).count() == 0


def test_transducer_long_units(spm):
    t = piece_transducer.Transducer(SPM, 1000)
    r = random.Random(3)
    for x in ("".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/", k=1_000_000)), "a" + " " * 100_000 + "b", "." * 100_000):
        ids = np.frombuffer(t.encode(x), "<u4").tolist()
        assert t.decode(ids) == x and (len(x) > 200_000 or ids == spm.encode(x))
    some = "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789+/", k=3000))
    assert np.frombuffer(t.encode(some), "<u4").tolist() == spm.encode(some)


def test_transducer_unigram(tmp_path, spm):
    """The same pieces taken as a unigram model: the library's best path."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.ParseFromString(open(SPM, "rb").read())
    m.trainer_spec.model_type = 1
    for p in m.pieces:
        if p.type == 1:
            p.score = -((hash_of(p.piece) % 1000) / 100 + 1 + len(p.piece))
    (tmp_path / "u.model").write_bytes(m.SerializeToString())
    lib, own = sentencepiece.SentencePieceProcessor(model_file=f"{tmp_path}/u.model"), piece_transducer.Transducer(f"{tmp_path}/u.model")
    cost = lambda ids: sum(-m.pieces[i].score for i in ids if m.pieces[i].type == 1)
    for x in texts(500, 9):
        a, b = np.frombuffer(own.encode(x), "<u4").tolist(), lib.encode(x)
        assert cost(a) == pytest.approx(cost(b), abs=1e-3) and own.decode(a) == own.decode(b)


def hash_of(s):
    return zlib.crc32(s.encode())


def test_quality_edges(spark):
    clean = "the cat and the dog of this house are in the garden with that man for an hour"
    rows = [*ODD, (30, clean, "s"), (31, clean.replace(" ", "### "), "s"), (32, " ".join(f"zq{k}x" for k in range(50)), "s"), (35, " ".join(f"zq{k}x" for k in range(49)), "s"), (36, " ".join(f"zq{k}x" for k in range(49)) + ' "The"', "s"), (33, "\n".join([clean] * 3), "s"), (34, "x " * 5, "s")]
    got = {r["doc_id"]: r for r in quality_rules.quality(docs(spark, rows)).collect()}
    assert {i: got[i]["kept"] for i in (1, 2, 3, 4, 6, 30, 31, 32, 33, 35, 36)} == {1: False, 2: False, 3: False, 4: False, 6: False, 30: True, 31: False, 32: False, 33: False, 35: True, 36: True}
    assert got[6]["n_repeat_words"] == 30000 and got[33]["n_dup_lines"] == 2 and got[34]["n_repeat_words"] == 0 and got[1]["n_words"] == 0
    out = quality_rules.filtered(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "source", "n_tokens", "row"] and sorted(r["doc_id"] for r in out.collect()) == [30, 35, 36]
    assert quality_rules.quality(docs(spark, [])).count() == 0


def test_quality_long_text_is_filtered(spark):
    clean = "the cat and the dog of this house are in the garden with that man for an hour"
    out = quality_rules.filtered(docs(spark, [(1, "word " * 30000, "s"), (2, clean, "s")]))
    assert [r["doc_id"] for r in out.collect()] == [2]


def exact(x, ids, q, k):
    s = x[q].astype(float) @ x.T.astype(float)
    out = {}
    for r, i in zip(s, ids[q]):
        order = sorted((-v, j) for v, j in zip(r, ids) if j != i)[:k]
        out[int(i)] = [(int(j), -v) for v, j in order]
    return out


def test_hnsw(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.stack(e["embedding"].to_numpy()), e["vec_id"].to_numpy()
    want = exact(x, ids, np.flatnonzero(ids % 20 == 0), 20)
    got = defaultdict(list)
    for r in catalog.QUERIES["op10_hnsw"](spark, sf).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got[r["query_id"]]) + 1
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hit = [len({j for j, _ in want[i]} & {j for j, _ in got[i]}) / 20 for i in want]
    assert set(got) == set(want) and np.mean(hit) > 0.95
    known = {i: dict(w) for i, w in want.items()}
    assert all(abs(s - known[i][j]) < 1e-12 for i, g in got.items() for j, s in g if j in known[i])


def test_hnsw_recall_in_shards(spark):
    r = np.random.default_rng(2)
    x = (r.normal(size=(30, 24))[r.integers(0, 30, 4000)] + 0.6 * r.normal(size=(4000, 24))) * r.uniform(0.2, 3, (4000, 1))
    x[1000:2000] = x[7]  # a vector that very many rows have
    x = x.astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    ids = np.arange(4000)
    want = exact(x, ids, np.flatnonzero(ids % 100 == 0), 10)
    got = defaultdict(list)
    for a in hnsw.nearest(rows, rows.where("vec_id % 100 = 0"), k=10, shard_rows=1500).orderBy("query_id", "rank").collect():
        got[a["query_id"]].append(a["vec_id"])
    assert np.mean([len({j for j, _ in want[i]} & set(got[i])) / 10 for i in want]) > 0.9
    assert got[1000] == [j for j, _ in want[1000]] and 7 in got[1000]


def test_hnsw_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [0.5, 0.5]), (None, [1.0, 1.0]), (9, [1.0, 1.0, 1.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in hnsw.nearest(df, df, k=5).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got if g[0] == 1] == [(1, 1, 2), (1, 2, 2), (1, 3, 8)] and {g[2] for g in got if g[0] == 8} == {1, 2} and {g[0] for g in got} == {1, 2, 8}
    assert [g[:3] for g in got if g[0] == 2] == [(2, 1, 1), (2, 2, 8)]
    more = spark.createDataFrame([(2, [0.1, 1.0], "x", 1)], "vec_id long, embedding array<float>, score string, rank int")
    both = defaultdict(list)
    for r in hnsw.nearest(df.withColumn("rank", F.lit("r")), df.unionByName(more, allowMissingColumns=True), k=2).orderBy("rank").collect():
        both[r["query_id"], r["query_hash"]].append(r["vec_id"])
    assert sorted(both.values()) == [[1, 2], [1, 8], [2, 2], [8, 1]] and [i for i, _ in both].count(2) == 2
    assert hnsw.nearest(df.where("false"), df).count() == 0 and hnsw.nearest(df, df.where("false")).count() == 0


def test_pipeline_edges(spark):
    """Nulls in all columns, empty and long texts, repeated rows and ids, names that clash, and no rows at all."""
    import corpus_pipeline

    extra = "`__gone` string, doc string, h long, row string, `all` string, kept boolean, own long, verdict string, `t` string"
    kind = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    say = lambda k: " ".join(f"word{k}x{j} the" for j in range(30))
    texts_ = [(1, say(1)), (1, say(1)), (2, say(1) + " more"), (3, None), (None, say(4)), (None, None), (5, ""), (6, " \n"), (7, "one"), (8, say(8) + " mail ann@example.org now"), (9, say(9)), (9, say(10)), (10, "the cat of " * 20000)]
    rows = [(i, t, None if k % 2 else "en", None if k % 3 else "s", None, "g", "d", 1, "r", "a", None, 2, "v", "t") for k, (i, t) in enumerate(texts_)]
    for some in (rows, []):
        docs_ = spark.createDataFrame(some, kind)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs_ = corpus_pipeline.workspace.materialize(stage(spark, docs_, ""), name)
            assert docs_.columns == [c.split()[0].strip("`") for c in kind.split(", ")]
        left = docs_.collect()
        assert sorted((r["doc_id"] or 0) for r in left) == ([0, 1, 1, 8, 9, 9] if some else [])
        assert all(r["n_chars"] == len(r["text"]) and r["row"] == "r" and r["own"] == 2 for r in left) and not any("ann@" in r["text"] for r in left)
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs_, "").collect()
        assert len(pieces) == len(left)


def test_pipeline(spark, sf):
    """Each stage against a plain version on its own input; the whole is their chain."""
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "minhash_dedup", "pseudonyms", "best_fit_packing"]
    frames = [spark.read.parquet(f"{sf}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(corpus_pipeline.workspace.materialize(stage(spark, frames[-1], sf), name))
    text = lambda f: {r["doc_id"]: r["text"] for r in f.collect()}
    for f in frames[:-1]:
        assert f.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = {r["doc_id"] for r in catalog.QUERIES["op9_quality_rules"](spark, sf).collect() if r["kept"]}
    assert set(text(frames[1])) == kept
    sites, first = defaultdict(set), {}
    for r in sorted(frames[1].collect(), key=lambda r: r["doc_id"]):
        for line in r["text"].split("\n"):
            sites[line].add(r["source"])
            first.setdefault(line, r["doc_id"])
    want = {i: "\n".join(x for x in t.split("\n") if not x.strip(" \t\n\r\x0b\x0c") or len(sites[x]) < 10 or first[x] == i) for i, t in text(frames[1]).items()}
    assert text(frames[2]) == want
    gone = {i for i, _, _, keep in map(ast.literal_eval, near_truth(text(frames[2]).items(), 5)) if not keep}
    assert set(text(frames[3])) == set(want) - gone
    names = pseudonyms.Pseudonyms(pseudonyms.TEST_KEY)
    assert text(frames[4]) == {i: names.text(t, {}) for i, t in text(frames[3]).items()}
    from tokenizers import Tokenizer

    hf = Tokenizer.from_file(WORD)
    pack = {i: [[*hf.encode(t or "", add_special_tokens=False).ids, 0]] for i, t in text(frames[4]).items()}
    check_packing(frames[5].collect(), pack)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, frames[5].select("doc_id", "piece", "ids_crc32").collect()))


def test_filter_comes_to_the_driver_as_arrow(spark):
    """The filter's words, not a Python object for each: 2 ** 15 words are 256 KB, and all hashes pass."""
    import tracemalloc

    ids = spark.range(200_000).select(F.xxhash64("id").alias("rep"))
    tracemalloc.start()
    made = minhash_dedup.bitmap(ids, 200_000, plain=True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made.value) == 1 << 15 and peak < 40 * len(made.value)
    assert minhash_dedup.passes(made.value, ids.toArrow().column(0).to_numpy()).all()
