"""The operators against brute force, SQL and exact round trips, with nulls, empty texts, ties and empty tables."""

import hashlib
import re

import duckdb
import pytest
import xxhash

from quarrymill.llm import catalog, chat, lines, media, mixing, pieces, quality, secrets, simhash, substrings

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long"
ODD = [
    (1, None, None, None, None, 1), (2, "", "en", "a", 0, 1), (3, " \n\t", "en", "a", 3, 1), (4, "x " * 60, "en", "a", 120, 1),
    (5, "one two\nthree four\nfive\n\none two\nthree four", "en", "b", 40, 1), (6, "one two\nthree four", "en", "b", 20, 1),
    (7, "one two\nthree four", "en", "b", 20, 1), (7, "one two\nthree four", "en", "b", 20, 1),
    (8, "a b " * 40, "en", "c", 160, 1), (9, " ".join(f"w{i}" for i in range(5000)), "en", "c", 9, 1), (10, " ".join(f"w{i}" for i in range(30, 90)), "en", "c", 9, 1),
    (11, 'password = "abc123"; Token: x_y_z_1 AKIA' + "Q" * 16 + " " + "0a" * 12, "en", "c", 9, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return (text or "").encode().split()


def brute_windows(rows, w=20):
    seen, out = set(), {}
    for i, text in sorted({(r[0], r[1] or "") for r in rows}):
        x = words(text)
        gone = [False] * len(x)
        for s in range(len(x) - w + 1):
            k = b" ".join(x[s : s + w])
            if k in seen:
                gone[s : s + w] = [True] * w
            seen.add(k)
        out[i] = (len(x), sum(gone), b" ".join(a for a, g in zip(x, gone, strict=True) if not g).decode())
    return out


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_substrings(request, which):
    df = request.getfixturevalue(which)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.deduplicated(df).collect()}
    assert got == brute_windows([(r["doc_id"], r["text"]) for r in df.collect()])


def brute_simhash(rows):
    fps = {}
    for i, text in rows:
        x = [w.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))) for w in words(text)]
        grams = [b" ".join(x[j : j + 3]) for j in range(max(1, len(x) - 2))] if x else []
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    root = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= 2 and root[j] < root[i]:
                    root[i], changed = root[j], True
    return {i: (f"{fps[i]:016x}", root[i]) for i in fps}


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_simhash(request, which):
    df = request.getfixturevalue(which)
    out = simhash.near_duplicates(df).select("doc_id", simhash.fingerprint_hex("fp").alias("f"), "component_id").collect()
    assert len(out) == df.count()
    assert {r[0]: (r[1], r[2]) for r in out} == brute_simhash([(r["doc_id"], r["text"]) for r in df.collect()])


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(catalog.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = catalog.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want.fetchall())


def test_lines_edges(odd):
    got = {r["doc_id"]: r["text"] for r in lines.deduplicated(odd).collect()}
    assert got[1] is None and got[2] == "" and got[5] == "one two\nthree four\nfive\n" and got[6] == "" and got[7] == ""


def test_chat_round_trip(spark):
    odd = [(1, 0, "system", "be <|end|> kind"), (1, 1, "user", None), (1, 2, "assistant", "a\\<s>"), (1, 3, "assistant", "w " * 50), (2, None, None, ""), (2, 1, "assistant", "[INST]|>\n")]
    df = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    made = chat.windows(df, budget=32, history=12)
    assert made.where("n_repeated > 0").count() > 0
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"]) for r in chat.read_back(made).collect()}
    for conv in (1, 2):
        own = [(r[2] or "", r[3] or "") for r in odd if r[0] == conv]
        digest = hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert got[conv] == (len(own), digest, sum(len(b) for a, b in own if a == "assistant"))


def test_pieces_round_trip(odd, docs):
    model = pieces.Model.read()
    codec = pieces.Codec(model)
    for text in [" a  b", "▁x▁", "\U0001f600 \ta", " "]:
        assert codec.decode(codec.encode(text)) == text
    for df in (odd, docs):
        back = pieces.decode(pieces.encode(df, model), model)
        assert sorted(map(tuple, back.collect()), key=repr) == sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_viterbi_is_best():
    names = [f"<0x{i:02X}>" for i in range(256)] + ["▁", "▁a", "ab", "b", "abc", "c", "bc"]
    codec = pieces.Codec(pieces.Model(names, [0.0] * 256 + [-1.0, -2.0, -2.5, -2.0, -9.0, -3.0, -2.2], ["byte"] * 256 + ["piece"] * 7))
    assert [names[i] for i in codec.encode("abc")] == ["▁a", "bc"]


def test_secrets_brute(docs, odd):
    for df in (docs, odd):
        text = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        for r in secrets.scan(df).collect():
            got = {(s["kind"], s["start"], s["end"]) for s in r["secrets"]}
            for kind, (pattern, group, least) in secrets.RULES.items():
                want = {(kind, m.start(), m.end()) for m in re.finditer(pattern, text[r["doc_id"]]) if m.end(group) - m.start(group) >= least}
                assert {g for g in got if g[0] == kind} == want


def test_mixing(docs, odd):
    for df in (docs, odd):
        plan = mixing.mix_plan(df).toPandas()
        assert len(plan) == df.count() and (plan.taken <= 3 * plan["size"]).all()
        assert abs(plan.drop_duplicates("source").target.sum() - plan["size"].sum()) < 1e-6


def test_media_round_trip(docs, odd):
    for df in (docs, odd):
        text = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
        for r in media.media_columns(df).collect():
            assert r["payload_sha256"] == hashlib.sha256(media.payload_of(text[r["doc_id"]])).hexdigest()


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    made = [substrings.deduplicated(none), simhash.near_duplicates(none), lines.deduplicated(none), secrets.scan(none), mixing.mix_plan(none), media.media_columns(none), pieces.encode(none), quality.score(none, None)]
    assert [m.count() for m in made] == [0] * len(made)


def test_trigram_queries():
    assert secrets.trigram_query(r"gh[pousr]_[A-Za-z0-9]{36,}") == ("or", (b"gho", b"ghp", b"ghr", b"ghs", b"ghu"))
    assert secrets.trigram_query(r"xox[ab]-x") == ("and", (b"xox", ("or", (b"oxa", b"oxb"))))
    assert secrets.trigram_query(r"[0-9a-f]+") is True and secrets.trigram_query(r"a[bc]d") is True
    assert secrets.trigram_query(r"ab[cé]def") == b"def"


def test_digests_of_base_secrets(odd, docs):
    """The contract's own patterns, kinds and digest."""
    keys = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    plain = {"assign": (rf"({keys})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6), "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24)}
    for df in (odd, docs):
        found = {}
        for r in df.collect():
            own = [(m.start(), k, kind, m.end()) for k, (kind, (p, g, n)) in enumerate(plain.items()) for m in re.finditer(p, r["text"] or "") if len(m.group(g)) >= n]
            found[r["doc_id"]] = hashlib.sha256(",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(own)).encode()).hexdigest()
        got = secrets.scan(df).collect()
        for r in got:
            base = [s for s in r["secrets"] if s["kind"] in secrets.BASE]
            assert hashlib.sha256(",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in base).encode()).hexdigest() == found[r["doc_id"]]


def test_media_facts(docs, odd):
    """All values that are read back, from the payload itself."""
    import zlib

    for df in (docs, odd):
        text = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
        for r in media.media_columns(df).collect():
            payload = media.payload_of(text[r["doc_id"]])
            stored = media.encode_png(payload)
            assert media.decode_png(stored) == payload
            assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (len(text[r["doc_id"]]), len(payload), zlib.crc32(payload[-32:]), len(stored), hashlib.sha256(stored).hexdigest())
            assert (r["width"], r["height"], r["bit_depth"], r["feature"]) == (576, len(payload) // 576, 8, media.feature_of(payload))
