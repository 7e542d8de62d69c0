"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skytally.llm import chat, cotrain, lines, lm, mih, minhash, mixing, packing, pieces, rules
from skytally.llm.queries import chat_events

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7 % 9001}" for i in range(30000))
TEXTS = [
    None, "", "   \n\t ", "One two three", "one TWO three", LONG, LONG + " more", "a b c d e f g h i j k",
    "A B C D E F G H I J K", "same line here\nother words", "same line here\nanother\n\nlast", "x" * 20000,
    "é 日本 \U0001f600 ▁ <|im_end|>", "# # # $ $ text of symbols & more < > words here", "dup\ndup\ndup\ndup of",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, [None, "en", "de"][k % 3], [None, "src0", "src1"][k % 2], None if t is None else len(t)) for k, t in enumerate(TEXTS)]
    rows += [rows[7], (None, "no id at all", "en", "src0", 12)]
    frame = spark.createDataFrame(rows, DOCS)
    # Columns with names that the operators use themselves.
    for name in ("n_words", "kept", "host", "known", "lines", "gone", "mix_group", "repeats", "key", "n", "sig", "block", "measures"):
        frame = frame.withColumn(name, F.lit("own"))
    return frame.cache()


def ids(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=lambda r: (r[0] is None, str(r)))


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words_of(text)
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts, num=85, den=100):
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys, holders = sorted(sets), defaultdict(list)
    for k in keys:
        shared = Counter()
        for s in sets[k]:
            shared.update(holders[s])
            holders[s].append(k)
        for o, both in shared.items():
            if den * both >= num * (len(sets[k]) + len(sets[o]) - both):
                a, b = find(k), find(o)
                root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_rules(spark, docs):
    found = {r["doc_id"]: r for r in rules.measured(docs, rules.RULES).collect() if r["doc_id"] is not None}
    for k, text in enumerate(TEXTS):
        w = (text or "").encode().split()
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {i + j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(5)}
        filled = [x for x in (text or "").split("\n") if x.encode().strip()]
        r = found[k]
        assert (r["n_words"], r["n_repeat_words"]) == (len(w), len(covered))
        assert r["word_chars"] == sum(len(x.decode()) for x in w)
        assert r["n_symbols"] == sum((text or "").count(c) for c in "#*$%&|<>")
        assert r["n_dup_lines"] == len(filled) - len(set(filled))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert r["base_failed"] <= (not r["kept"])
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r[0] for r in ids(kept)} == {k for k, r in found.items() if r["kept"]}
    assert [r.name for r in sorted(rules.order_rules(docs))] == sorted(r.name for r in rules.RULES)
    assert rules.keep_good(docs.limit(0)).count() == rules.measured(docs.limit(0), rules.RULES).count() == 0


def test_lines_of_small_and_large_hosts(spark):
    """One rule: a header on all of 3 or 19 pages goes, one on two of 20 or 1,000 pages stays."""
    rows = []
    for host, pages in (("h3", 3), ("h19", 19), ("h20", 20), ("h1000", 1000)):
        for k in range(pages):
            head = f"header of {host}\n" if host != "h1000" or k < 51 else ""
            rows.append((host, head + ("two of them\n" if k < 2 else "") + ("half\n" if k < 50 else "") + f"own {k}"))
    frame = spark.createDataFrame(rows, "source string, text string")
    left = Counter((r["source"], line) for r in lines.drop_boilerplate(frame).collect() for line in r["text"].split("\n"))
    assert not any(line.startswith("header") for _, line in left)
    assert {k: n for k, n in left.items() if k[1] == "two of them"} == {(h, "two of them"): 2 for h in ("h3", "h19", "h20", "h1000")}
    assert {k: n for k, n in left.items() if k[1] == "half"} == {("h1000", "half"): 50}
    assert sum(n for (_, line), n in left.items() if line.startswith("own")) == 1042


def test_rules_give_the_same_verdict_in_any_order(docs):
    assert ids(rules.cascade(docs, rules.RULES), "kept") == ids(rules.cascade(docs, rules.RULES[::-1]), "kept")


def test_costly_rule_with_few_rejections_goes_last(spark):
    rows = spark.createDataFrame([(f"text {i} of no interest at all, but a few words",) for i in range(300)], "text string")
    slow = rules.Rule("slow", lambda t: not sum(i for i in range(20000)))
    fast = rules.Rule("fast", lambda t: t.n_words > 1)
    assert [r.name for r in rules.order_rules(rows, (slow, fast))] == ["fast", "slow"]


def test_lines(spark, docs):
    rows = [(k, "site rules\npage %d\n\nsite rules" % k if k % 2 else "page %d\n" % k, "a") for k in range(10)]
    rows += [(99, None, "a"), (98, "", "a"), (97, "site rules\nalone", "b"), (96, "site rules", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("host", F.lit(1))
    out = {r["doc_id"]: (r["text"], r["gone"]) for r in lines.drop_boilerplate(frame, ratio=0.3, min_pages=3, dropped="gone").collect()}
    assert out[1] == ("page 1\n", 2) and out[2] == ("page 2\n", 0)
    assert out[99] == (None, 0) and out[98] == ("", 0) and out[97] == ("site rules\nalone", 0)
    assert lines.drop_boilerplate(docs).columns == docs.columns
    assert ids(lines.drop_boilerplate(docs), "text") == ids(docs, "text")
    # Five of twelve pages are exactly at this ratio: only more than it counts.
    kept = lines.drop_boilerplate(frame, ratio=5 / 12, min_pages=3)
    assert ids(kept, "text") == ids(frame, "text")
    assert lines.drop_boilerplate(docs.limit(0)).count() == 0


def test_near_duplicates(spark, docs):
    out = minhash.near_duplicates(docs)
    want = brute_components(dict(enumerate(TEXTS)))
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(TEXTS) + 2
    assert {r[0]: r[1:] for r in got if r[0] is not None} == want
    assert [r[2] for r in got if r[0] is None] == [None]
    stay = minhash.one_of_each(docs)
    assert stay.columns == docs.columns
    assert {r[0] for r in ids(stay)} == {k for k, (_, c) in want.items() if k == c} | {None}
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_of_chains_and_shared_passages(spark):
    random = np.random.default_rng(5)
    word = lambda n: [f"v{x}" for x in random.integers(0, 10**6, n)]
    texts, passage = [], word(60)
    for _ in range(60):  # short texts around one passage: alike, but not enough
        texts.append(" ".join(word(5) + passage + word(6)))
    base = word(200)
    for k in range(60):  # each differs a little from the one before, and much from the first
        texts.append(" ".join(base))
        base = base[: 3 * k] + word(2) + base[3 * k + 2 :]
    texts += [" ".join(word(40)) for _ in range(50)] * 2
    order = random.permutation(len(texts))
    table = {int(i): texts[k] for k, i in enumerate(order)}
    frame = spark.createDataFrame(list(table.items()), "doc_id long, text string")
    assert {r[0]: (r[1], r[2]) for r in minhash.near_duplicates(frame).collect()} == brute_components(table)


def test_one_of_each_compares_rows_with_any_ids(spark):
    random = np.random.default_rng(7)
    word = lambda n: [f"v{x}" for x in random.integers(0, 10**6, n)]
    base, rows = word(300), []
    for k in range(40):  # 296 shingles, of which k // 5 * 5 + 5 are others: similarity from 0.97 to 0.76
        cut = k // 5 * 5 + 5
        rows.append((10 + k, " ".join(word(100) + base[:cut])))
        rows.append((60 + k, rows[-1][1] + " " + " ".join(word(cut))))
    rows += [rows[0], rows[0], (None, rows[2][1]), (None, "no id " + " ".join(base)), (None, "no id " + " ".join(base))]
    rows += [(5, "one text " + " ".join(word(20))), (5, "another text " + " ".join(word(20))), (None, None), (None, None), (6, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("own")).repartition(3)
    kept = [(r["doc_id"], r["text"]) for r in minhash.one_of_each(frame, num=80, bands=37).collect()]
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = brute_components({k: t for k, (_, t) in enumerate(order)}, 80)
    assert sorted(kept, key=str) == sorted((order[k] for k, (_, c) in want.items() if k == c), key=str)
    assert any(len(brute_components({0: a, 1: b}, 80)) == 2 for (_, a), (_, b) in zip(rows[::2], rows[1::2]))


def test_links_between_components_of_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP", 3)
    random = np.random.default_rng(6)
    base = [f"v{x}" for x in random.integers(0, 10**6, 300)]
    table = {k: " ".join(base[: 300 - k]) for k in range(0, 80, 8)}
    frame = spark.createDataFrame(list(table.items()), "doc_id long, text string")
    close = spark.createDataFrame([(1, k, k) for k in table], "bucket long, doc_id long, component long")
    links = {tuple(r) for r in minhash._links_between(close, frame, 85, 100).collect()}
    assert links and all(100 * len(shingles(table[a]) & shingles(table[b])) >= 85 * len(shingles(table[a]) | shingles(table[b])) for a, b in links)
    from skytally.llm import graph

    joined = {tuple(r) for r in graph.components(spark.createDataFrame(list(links), "a long, b long")).collect()}
    assert joined == {(k, c) for k, (_, c) in brute_components(table).items()}


def test_hot_bucket_is_compared_in_tiles(spark, monkeypatch):
    """Texts that share most of their words, in one bucket, some alike enough; tiles of few members and of few shingles."""
    random = np.random.default_rng(8)
    base, table = [f"v{x}" for x in random.integers(0, 10**6, 200)], {}
    for k in range(90):
        own = [f"o{k}x{i}" for i in range(40 if k % 3 else 4)]
        table[k] = " ".join(base[: 200 - k // 2] + own)
    frame = spark.createDataFrame(list(table.items()), "doc_id long, text string")
    want = brute_components(table)
    assert 1 < len({c for _, c in want.values()}) < 90
    for group, shingle_limit in ((1000, 500_000), (7, 500_000), (1000, 900)):
        monkeypatch.setattr(minhash, "GROUP", group)
        monkeypatch.setattr(minhash, "GROUP_SHINGLES", shingle_limit)
        assert {r[0]: (r[1], r[2]) for r in minhash.near_duplicates(frame).collect()} == want
    rows = spark.createDataFrame([(1, k, k, 200) for k in range(90)], "bucket long, doc_id long, component long, n long")
    tiles = minhash._tiles(rows).groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    assert len(tiles) == 20 * 21 // 2 and max(r["n"] for r in tiles) < 5000


def test_signature_estimates_similarity():
    random = np.random.default_rng(0)
    errors = []
    for _ in range(200):
        u = random.integers(0, 2**63, 400, dtype=np.uint64)
        sets = [np.unique(u[:300]), np.unique(u[100:])]
        sig = minhash.signatures(np.concatenate(sets), np.array([300, 300]))
        errors.append((sig[0] == sig[1]).mean() - 0.5)
    # Less spread than with independent places.
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < (0.25 / minhash.PLACES) ** 0.5


def test_mixing(spark, docs):
    levels = {"domain": F.lit("web"), "language": F.col("lang"), "origin": F.col("source")}
    out = mixing.mix(docs, levels, [{}, {"en": 3}, {}], share=(1, 2))
    total = sum(r["n_tokens"] for r in out.collect())
    used = sum(r["n_tokens"] * r["repeats"] for r in out.collect())
    assert used <= total // 2 and {r["repeats"] for r in out.collect()} <= {0, 1, 2}
    assert mixing.mixed(docs, levels, [{}, {}, {}], share=(2, 1)).columns == docs.columns
    # Twice all tokens: every text of a group with tokens is read twice.
    full = mixing.mix(docs, levels, [{}, {}, {}], share=(2, 1)).collect()
    held = {r["mix_group"] for r in full if r["n_tokens"]}
    assert all(r["repeats"] == 2 for r in full if r["mix_group"] in held)
    assert mixing.mix(docs, levels, [{}, {}, {}], share=(0, 1)).filter("repeats > 0").count() == 0
    assert mixing.mixed(docs.limit(0), levels, [{}, {}, {}]).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "a", "x", 10) for i in range(1)] + [(10 + i, "a", "y", 10) for i in range(30)] + [(50 + i, "b", "z", 10) for i in range(30)]
    frame = spark.createDataFrame(
        [(i, " ".join(["w"] * n), d, s) for i, d, s, n in rows], "doc_id long, text string, d string, s string"
    )
    out = mixing.mix(frame, {"d": F.col("d"), "s": F.col("s")}, [{}, {}], share=(1, 2), max_epochs=1, bucket_rows=4)
    used = Counter()
    for r in out.collect():
        used[r["mix_group"]["s"]] += r["n_tokens"] * r["repeats"]
    # Half of 610 is 152 for each domain; of a's, x can use 10 only, and y has the rest.
    assert used == {"x": 10, "y": 140, "z": 150}


def test_chat(spark):
    rows = [
        (1, 0, "user", "hi <|im_end|> <\\| <|"), (1, 1, "assistant", None), (1, 1, "assistant", "tie"), (2, 0, "assistant", "é" * 1000),
        (1, None, None, "first"), (None, 0, "odd\nrole\\<|", "x\n<|im_start|>user\n"), (3, 0, "user", ""), (1, 0, "user", "hi <|im_end|> <\\| <|"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(9))
    out = {r["conv_id"]: r for r in chat.read_back(chat.render(chat.fold(chat_events(frame)))).collect()}
    for conv in (1, 2, 3, None):
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        want = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = out[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(learned))
        assert r["turns_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.read_back(chat.render(chat.fold(chat_events(frame.limit(0))))).count() == 0


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, "m1", 1, "start", "user", ""), (1, "m1", 2, "delta", None, "helo"), (1, "m1", 3, "edit", None, "hello"),
        (1, "m2", 4, "start", "assistant", ""), (1, "m2", 5, "delta", None, "bad"), (1, "m2", 6, "regenerate", None, None),
        (1, "m2", 8, "delta", None, "re"), (1, "m2", 7, "delta", None, "good "), (1, "m1", 9, "delta", None, "!"), (1, "m3", 10, None, None, None),
    ]
    frame = spark.createDataFrame(log, "conv_id long, message string, seq long, kind string, role string, text string")
    out = sorted(tuple(r) for r in chat.fold(frame).collect())
    assert out == [(1, 1, "user", "hello!"), (1, 4, "assistant", "good re"), (1, 10, "", "")]


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_pieces(spark, docs):
    out = pieces.sample_segmentations(docs, MODEL, k=3)
    found = defaultdict(list)
    for r in out.collect():
        assert r["restored"] and r["n_pieces"] == len(r["ids"]) and 0 <= r["inclusion"] <= 1
        found[r["doc_id"]].append((r["sample"], tuple(r["ids"]), r["log_prob"], r["inclusion"]))
    for k in range(len(TEXTS)):
        samples = set(found[k])
        assert len({s[1] for s in samples}) == max(s[0] for s in samples) == len({s[0] for s in samples})
    assert found[0] == [(1, (), 0.0, 1.0)] == found[1]
    # The same rows give the same samples in another partitioning, alone or among others.
    again = pieces.sample_segmentations(docs.repartition(5).filter("doc_id IN (7, 9)"), MODEL, k=3)
    assert {(r["doc_id"], r["sample"], tuple(r["ids"])) for r in again.collect()} == {
        (k, s[0], s[1]) for k in (7, 9) for s in found[k]
    }
    assert pieces.sample_segmentations(docs.limit(0), MODEL).count() == 0


def test_pieces_are_sampled_by_their_probability_without_replacement():
    lattices = pieces.Lattices(MODEL, 0.5)

    def all_of(text):
        if not text:
            yield (), 0.0
        for j in range(1, len(text) + 1):
            if text[:j] in lattices.pieces:
                k, s = lattices.pieces[text[:j]]
                for rest, q in all_of(text[j:]):
                    yield (k, *rest), s + q

    p = {a + b: np.exp(s + q) for a, s in all_of(" the") for b, q in all_of(" of")}
    p = {k: v / sum(p.values()) for k, v in p.items()}
    n = 20000
    found = list(pieces.sample_texts(lattices, pieces.mixed(np.arange(n, dtype=np.uint64)), ["the of"] * n, 2))
    first = Counter(tuple(f[0][0].tolist()) for f in found)
    both = Counter((tuple(f[0][0].tolist()), tuple(f[1][0].tolist())) for f in found)
    top = sorted(p, key=p.get, reverse=True)[:4]
    for a in top:
        assert abs(first[a] / n - p[a]) < 5 * (p[a] / n) ** 0.5
        for b in top:
            if a != b:
                want = p[a] * p[b] / (1 - p[a])
                assert abs(both[a, b] / n - want) < 5 * (want / n) ** 0.5 + 1e-3
    # Inclusion scores weigh samples so that sums over samples are unbiased.
    assert abs(np.mean([sum(np.exp(l) / q for _, l, q in f) for f in found]) - 1) < 0.02


@pytest.mark.parametrize("text", ["   if x", "a  \n   b", "x" * 2 + " " * 3])
def test_runs_of_blanks_use_all_pieces_of_the_model(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    pieces_of = {model.id_to_piece(i).replace(pieces.MARK, " "): i for i in range(model.get_piece_size()) if not model.is_byte(i) and i > 2}

    def all_of(rest):
        if not rest:
            yield (), 0.0
        elif rest[0] == "\n":
            i = next(i for i in range(model.get_piece_size()) if model.is_byte(i) and model.id_to_piece(i) == "<0x0A>")
            for tail, q in all_of(rest[1:]):
                yield (i, *tail), q - 0.5 * np.log(4 * model.get_piece_size())
        for j in range(1, len(rest) + 1):
            if rest[:j] in pieces_of:
                for tail, q in all_of(rest[j:]):
                    yield (pieces_of[rest[:j]], *tail), q - 0.5 * np.log(pieces_of[rest[:j]] + 3)

    total = {ids: q for ids, q in all_of(" " + text)}
    norm = np.log(sum(np.exp(q) for q in total.values()))
    lattices, n = pieces.Lattices(MODEL, 0.5), 4000
    seen = Counter()
    for found in pieces.sample_texts(lattices, pieces.mixed(np.arange(n, dtype=np.uint64)), [text] * n, 2):
        for ids, logp, _ in found:
            assert abs(total[tuple(ids.tolist())] - norm - logp) < 1e-9
            assert lattices.decode(ids.tolist()) == text
        seen[tuple(found[0][0].tolist())] += 1
    for ids in sorted(total, key=total.get)[-5:]:
        p = np.exp(total[ids] - norm)
        assert abs(seen[ids] / n - p) < 5 * (p / n) ** 0.5


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_packing(spark, docs, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "BLOCK_IDS", 100)
    path = str(tmp_path / "tokens")
    packing.write_tokens(docs, path, TOKENIZER)
    out = packing.map_texts(packing.read_blocks(spark, path), "ids_crc32 long", packing.crc32).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in sorted(out, key=lambda r: r["start"])] == [k for k, _ in rows]
    at, want = 0, []
    for k, text in rows:
        own = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((k, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    assert sorted(tuple(r) for r in out if r[0] is not None) == sorted(w for w in want if w[0] is not None)
    [found] = {tuple(x.tolist()) for x in packing.tokens_of(spark, path, 7)}
    assert list(found) == [*plain.encode(TEXTS[7], add_special_tokens=False).ids, 2]
    packing.write_tokens(docs.limit(0), path + "0", TOKENIZER)
    assert packing.map_texts(packing.read_blocks(spark, path + "0"), "ids_crc32 long", packing.crc32).count() == 0


def test_encoding_in_pieces_equals_encoding_whole():
    encoder = packing.Encoder(TOKENIZER)
    texts = ["a\t b", "a \tb  c", "x\xa0y z", "<|endoftext|> a", "  a b\n\n c ", "a\n b", "don't we'll 12 3.5 é—ü\n日本", "", "a\x1cb c", "a\r\nb c d e", "\n", " "]
    texts += [t for t in TEXTS if t]
    assert encoder.encode(texts) == encoder._whole(texts)


def test_encoding_in_pieces_of_any_white_space():
    encoder = packing.Encoder(TOKENIZER)
    texts = ["a\n\u00a0\u00a0b", "a\n\t\tb", "a \u3000\u3000b c", "a\u2003\u2003\nb", "a\u00a0b c\nd"]
    random = np.random.default_rng(11)
    parts = ["a", "word", "12", "é", " ", " ", "\n", "\t", "\r", "\u00a0", "\u00a0\u00a0", "\u2003", "\u3000", "\x85", "\x1c", "\u2028", "\u180e", "\u200b"]
    texts += ["x" + "".join(random.choice(parts, random.integers(2, 12))) + "y" for _ in range(20000)]
    wrong = [t for t, a, b in zip(texts, encoder.encode(texts), encoder._whole(texts)) if a != b]
    assert wrong == []
    assert encoder._pieces("plain words\nof a text") is not None


def test_ids_are_the_plain_librarys():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    random = np.random.default_rng(12)
    parts = ["a", "b1,", "'s", "\u00e9", "\u65e5\u672c", "!", " ", " ", " ", "\n", "\t", "\u00a0", "<|endoftext|>", "<|", "|>", "\x1c"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", ""] + ["".join(random.choice(parts, random.integers(0, 12))) for _ in range(20000)]
    ids = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    encoder = packing.Encoder(TOKENIZER)
    assert encoder.encode(texts) == ids
    assert len(np.frombuffer(encoder.encode(["a <|endoftext|> b"])[0], "<u4")) == 4
    # As an option the contents of special tokens are ordinary text.
    spelled = packing.Encoder(TOKENIZER, plain_specials=True)
    plain.encode_special_tokens = True
    assert spelled.encode(texts) == [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_forgotten_pieces_come_back(monkeypatch):
    monkeypatch.setattr(packing, "MAX_KNOWN", 40)
    encoder = packing.Encoder(TOKENIZER)
    random = np.random.default_rng(13)
    for _ in range(50):
        texts = [" ".join(random.choice([f"w{k}" for k in range(300)], 30)) for _ in range(3)]
        assert encoder.encode(texts) == encoder._whole(texts)
        assert len(encoder._known) == len(encoder._uses) == len(encoder._begins) - 1 < 140


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001, dtype=np.uint64).astype(np.uint32)
    data = packing.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    for a, b in ((0, 1001), (17, 533), (5, 5), (1000, 1001)):
        assert packing.unpack(data, bits, a, b).tolist() == ids[a:b].tolist()
    assert packing.bits_for(50257) == 16 and packing.bits_for(1) == 1 and packing.bits_for(2**16 + 1) == 17


def test_classifier(spark):
    random = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(600):
        good = k % 3 > 0
        text = " ".join(random.choice(["river", "stone", "light", "water"] if good else ["$$$", "&&&", "win", "###"], 30))
        rows.append((k, text, None if k % 7 == 0 else "en", f"src{k % 5}", len(text)))
        if k < 300:
            labels.append((k, int(good)))
    rows += [(600, None, None, None, None), (601, "", "en", "src0", 0), rows[0], (None, "river stone", "en", "src1", 11)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("score", F.lit("own"))
    known = spark.createDataFrame([*labels, (0, None), (5, 9), (1, 0), (None, 1)], "doc_id long, quality int")
    out = cotrain.classify(frame, known).collect()
    assert len(out) == len(rows)
    held = [r for r in out if r["doc_id"] is not None and 300 <= r["doc_id"] < 600]
    assert sum(r["kept"] == (r["doc_id"] % 3 > 0) for r in held) / len(held) > 0.98
    assert len({r["score"] for r in out if r["doc_id"] == 0}) == 1
    nothing = cotrain.classify(frame, known.filter("quality = 7")).collect()
    assert {(r["score"], r["kept"]) for r in nothing} == {(0.5, True)}
    one = cotrain.classify(frame, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")).collect()
    assert {r["score"] for r in one} == {0.75}
    assert cotrain.classify(frame.limit(0), known).count() == 0


def test_classifier_equals_co_training_in_memory(spark):
    """Each round's pseudo-labels are the surest of all unlabelled rows, wherever they lie; copies count once."""
    random = np.random.default_rng(4)
    rows, labels = [], []
    for k in range(1500):
        good = random.random() < 0.6
        share = random.random() * 0.6 + (0.4 if good else 0)
        text = " ".join("river" if random.random() < share else "###" for _ in range(20))
        rows.append((k, text, "en" if random.random() < (0.8 if good else 0.3) else "de", f"src{int(random.random() * 4) if good else 4}", len(text)))
        if k < 120:
            labels.append((k, int(good)))
    rows += rows[1400:1420] * 3
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    features = cotrain.featured(docs.withColumn("n_chars", F.col("n_chars").cast("double")), known, "quality").toPandas()
    views = [np.stack([np.frombuffer(x, np.float32) for x in features[c]]).astype(float) for c in ("text_view", "meta_view")]
    once = features.assign(at=range(len(features)))[features["y"].isna()].drop_duplicates("key").sort_values("key")["at"].to_numpy()
    named = features.assign(at=range(len(features)))[features["y"].notna()].sort_values(["text_view", "meta_view", "y"], kind="stable")
    held = {r["doc_id"]: r["held"] for r in known.select("doc_id", (F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(10)) < 3).alias("held")).collect()}
    at = named["at"].to_numpy()
    parts = (tuple(v[at] for v in views), named["y"].to_numpy(float), named["doc_id"].map(held).to_numpy(bool))
    model = cotrain.co_train(*parts, tuple(v[once] for v in views), per_round=60)
    want = dict(zip(features["doc_id"], model.score(tuple(views))))
    found = {r["doc_id"]: r["score"] for r in cotrain.classify(docs, known, per_round=60).collect()}
    assert found.keys() == want.keys() and max(abs(found[k] - want[k]) for k in want) < 1e-6
    alone = cotrain.co_train(*parts, tuple(v[once] for v in views), rounds=0)
    assert max(abs(alone.score(tuple(views)) - model.score(tuple(views)))) > 0.01


def test_each_view_teaches_the_other():
    random = np.random.default_rng(2)

    def views(n):
        y = (random.random(n) < 0.5).astype(float)
        return y, tuple(np.stack([y + random.normal(0, s, n), random.normal(size=n)], axis=1) for s in (0.2, 0.4))

    y, few = views(24)
    _, pool = views(2000)
    test_y, test = views(2000)
    held = np.arange(24) % 2 == 0
    alone = cotrain.co_train(few, y, held, pool, rounds=0)
    taught = cotrain.co_train(few, y, held, pool, rounds=3)
    hit = lambda m: ((m.score(test) > 0.5) == test_y).mean()
    assert hit(taught) > 0.97 and hit(taught) >= hit(alone) - 0.005


def test_co_training_gains_over_labels_alone():
    """Views of one telling and eight idle numbers: few labels mislead each view, and the other one's sure rows mend it."""
    for seed in (2, 3, 4):
        random = np.random.default_rng(seed)

        def views(n):
            y = (random.random(n) < 0.5).astype(float)
            return y, tuple(np.stack([y + random.normal(0, s, n), *random.normal(size=(8, n))], axis=1) for s in (0.25, 0.4))

        (y, few), (_, pool), (test_y, test) = views(40), views(2000), views(2000)
        held = np.arange(40) % 2 == 0
        hit = lambda rounds: ((cotrain.co_train(few, y, held, pool, rounds).score(test) > 0.5) == test_y).mean()
        assert hit(3) > hit(0) + 0.02


def test_nearest(spark):
    random = np.random.default_rng(3)
    v = random.normal(size=(3000, 24))
    v[5], v[7] = v[3], v[3] * 4
    rows = [(k, [float(y) for y in x]) for k, x in enumerate(v)]
    rows += [(20000, None), (20020, [0.0] * 24), (20040, [float("nan")] * 24), (20060, [None] * 24), (20080, [1.0]), (None, rows[0][1]), rows[100]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("own")).withColumn("v", F.lit(1))
    out = mih.nearest(frame, F.col("vec_id") % 20 == 0, k=20)
    found = defaultdict(list)
    for r in out.collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {k for k in range(0, 3000, 20)}
    hits = 0
    own = np.array([k for k, x in rows if k is not None and k < 20000])
    w = np.array([x for k, x in rows if k is not None and k < 20000])
    for q in found:
        if q == 100:
            continue  # asked twice, as it stands twice in the table
        score = w @ v[q]
        score[own == q] = -np.inf
        best = own[np.lexsort((own, -score))[:20]]
        got = sorted(found[q])
        assert [r[0] for r in got] == list(range(1, 21))
        assert [(-r[2], r[1]) for r in got] == sorted((-r[2], r[1]) for r in got)
        assert all(abs(r[2] - v[r[1]] @ v[q]) < 1e-9 for r in got)
        hits += len(set(best) & {r[1] for r in got})
    assert hits / (20 * (len(found) - 1)) >= 0.9
    few = frame.filter("vec_id < 6 OR vec_id = 20020")
    got = sorted(tuple(r) for r in mih.nearest(few, F.col("vec_id") % 20 == 0).collect())
    assert [r[1] for r in got] == [1, 2, 3, 4, 5] and {r[2] for r in got} == {1, 2, 3, 4, 5}
    assert mih.nearest(frame, F.lit(False)).count() == mih.nearest(frame.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("radius", [None, 0, 64])
def test_repeated_queries_find_all_their_ranks(spark, radius):
    v = np.random.default_rng(9).normal(size=(300, 16))
    rows = [(k, [float(y) for y in x]) for k, x in enumerate(v)]
    rows += [rows[20], rows[40], rows[40], (60, rows[7][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = mih.nearest(frame, F.col("vec_id") % 20 == 0, k=20, radius=radius).collect()
    assert Counter(r["query_id"] for r in found) == {q: 40 if q == 60 else 20 for q in range(0, 300, 20)}
    own, w = np.array([k for k, _ in rows]), np.array([x for _, x in rows])
    for q in (0, 20, 40):
        got = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
        score = np.where(own == q, -np.inf, w @ v[q])
        best = own[np.lexsort((own, -score))[:20]].tolist()
        assert [r[0] for r in got] == list(range(1, 21))
        assert [r[1] for r in got] == best if radius is not None else len(set(best) & {r[1] for r in got}) >= len(set(best)) - 3
    both = {r["vec_id"] for r in found if r["query_id"] == 60 and r["rank"] == 1}
    assert radius is None or both == {int(own[np.argmax(np.where(own == 60, -np.inf, w @ x))]) for x in (v[60], v[7])}


def test_small_radius_still_gives_k_rows(spark):
    v = np.random.default_rng(4).normal(size=(200, 16))
    frame = spark.createDataFrame([(k, [float(y) for y in x]) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    out = mih.nearest(frame, F.col("vec_id") % 20 == 0, k=20, radius=0).collect()
    assert Counter(r["query_id"] for r in out) == {q: 20 for q in range(0, 200, 20)}
    for q in range(0, 200, 20):
        best = np.argsort(-np.where(np.arange(200) == q, -np.inf, v @ v[q]), kind="stable")[:20]
        assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] == best.tolist()


def brute_scores(texts, held, order):
    """Katz by the book, with dictionaries."""
    tokens = {k: [*words_of(t), b"\n"] for k, t in texts.items()}
    counts = [Counter() for _ in range(order + 1)]
    for k, w in tokens.items():
        if not held[k]:
            for m in range(1, order + 1):
                full = [b"\t"] * (m - 1) + w
                counts[m].update(tuple(full[i : i + m]) for i in range(len(w)))
    total, distinct = sum(counts[1].values()), len(counts[1])
    discounts = {m: [0, *lm.good_turing([sum(c == r for c in counts[m].values()) for r in range(1, lm.K + 2)])] for m in range(2, order + 1)}
    follow = {m: defaultdict(dict) for m in range(2, order + 1)}
    for m in follow:
        for gram, c in counts[m].items():
            follow[m][gram[:-1]][gram[-1]] = c

    def weights(m, h):
        seen = follow[m].get(h)
        if not seen:
            return 0, 1.0
        n = sum(seen.values())
        lost = sum(c * (1 - discounts[m][c]) for c in seen.values() if c <= lm.K)
        n, lost = (n, lost) if lost > 1e-9 else (n + 1, 1.0)
        return n, lost / n / (1 - sum(prob(m - 1, h[1:], w) for w in seen))

    def prob(m, h, w):
        if m == 1:
            return (counts[1][(w,)] + 0.5) / (total + 0.5 * (distinct + 1))
        c, (n, weight) = follow[m].get(h, {}).get(w, 0), weights(m, h)
        return (discounts[m][c] if c <= lm.K else 1) * c / n if c else weight * prob(m - 1, h[1:], w)

    out = {}
    for k, w in tokens.items():
        full = [b"\t"] * (order - 1) + w
        out[k] = (
            len(w), sum((x,) in counts[1] for x in w), total, sum(np.log10(prob(1, (), x)) for x in w),
            sum(np.log10(prob(order, tuple(full[i : i + order - 1]), full[i + order - 1])) for i in range(len(w))),
        )
    history = next(iter(follow[order]))
    assert abs(sum(prob(order, history, w) for (w,) in counts[1]) + prob(order, history, b"\v") - 1) < 1e-9
    return out


@pytest.mark.parametrize(
    "n", [[184712, 23127, 5984, 1951, 2262, 607], [1482341, 227973, 46941, 19718, 17404, 6993], [100, 20, 0, 4, 3, 0], [900, 200, 80, 40, 30, 0]]
)
def test_good_turing_of_counts_that_do_not_fall(n):
    d, r = lm.good_turing(n), np.arange(1, lm.K + 1)
    assert ((d > 0) & (d < 1)).all() and (np.diff(r * d) > 0).all()
    # Not one absolute discount for all counts.
    assert np.ptp(r * (1 - d)) > 0.05
    if n[5]:
        common = 6 * n[5] / n[0]
        own = [((k + 1) * n[k] / (k * n[k - 1]) - common) / (1 - common) for k in (1, 2, 3)]
        assert np.allclose(d[:2], own[:2])


def test_good_turing_of_falling_counts_is_as_it_was():
    n = [1000, 300, 150, 90, 62, 45]
    common = 6 * 45 / 1000
    assert np.allclose(lm.good_turing(n), [((k + 1) * n[k] / (k * n[k - 1]) - common) / (1 - common) for k in range(1, 6)])


@pytest.mark.parametrize("order", [2, 3])
def test_language_model(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 100)  # so that frequent histories are split
    random = np.random.default_rng(8)
    texts = {k: " ".join(random.choice(list("abcdefghij") + ["the"] * 20, 20)) for k in range(60)}
    texts |= {60: None, 61: "", 62: " \n", 63: "The ZEBRA the zebra", 64: texts[3], 65: "q" * 5000}
    held = {k: k % 5 == 1 for k in texts}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("n_tokens", F.lit("own")).repartition(3)
    out = lm.score(frame, F.col("doc_id") % 5 == 1, order)
    want = brute_scores(texts, held, order)
    for r in out.collect():
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (*w[:3], held[r["doc_id"]])
        assert abs(r["base_score"] - w[3]) < 1e-8 and abs(r["score"] - w[4]) < 1e-8
    assert out.count() == len(texts)
    assert lm.score(frame.limit(0), F.lit(False)).count() == 0
    odd = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert [r["n_tokens"] for r in lm.score(odd, F.col("doc_id") == 1, order).collect()] == [3, 3, 3]
    none = lm.score(odd, F.lit(True), order).collect()
    assert {(r["train_tokens"], r["score"], r["base_score"]) for r in none} == {(0, 0.0, 0.0)}


def test_language_model_of_one_hot_word_and_one_long_text(spark, monkeypatch):
    """A word that is a third of all tokens is split; so is one before it that nearly always goes with it."""
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 60)
    random, rounds = np.random.default_rng(3), []
    texts = {k: " ".join(f"{w} of the" for w in random.integers(0, 30, 12)) for k in range(40)}
    texts[40] = " ".join(f"w{w}" for w in random.zipf(1.5, 600))
    counted = lm._counted

    def noted(requests, facts):
        rounds.append((requests.count(), facts))
        return counted(requests, facts)

    monkeypatch.setattr(lm, "_counted", noted)
    held = {k: k % 5 == 1 for k in texts}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    out = lm.score(frame, F.col("doc_id") % 5 == 1, 3).collect()
    want = brute_scores(texts, held, 3)
    for r in out:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert abs(r["base_score"] - w[3]) < 1e-7 and abs(r["score"] - w[4]) < 1e-7
    (messages, facts), = rounds
    # Not a message per block and bucket: each holds an n-gram.
    assert facts.split and facts.n_buckets > 30 and messages < facts.tokens


def test_messages_of_a_block_are_bounded_by_its_n_grams():
    """However many buckets there are, and however often words are split."""
    random = np.random.default_rng(5)
    words = np.sort(lm.mixed(np.arange(1, 61, dtype=np.uint64)))
    token = random.integers(0, 60, 900) * (random.random(900) < 0.6)
    counts = np.bincount(token, minlength=60)
    rank = np.empty(60, np.uint32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(60)
    texts = lm.dump(np.arange(3), np.zeros(3, np.uint8), np.full(3, 300))
    for n_buckets in (10, 1_000, 100_000, 10_000_000):
        block = lm.Block(texts, lm.dump(lm._deltas(words), counts), lm.dump(rank[token]))
        facts = lm.Facts(3, 900 * n_buckets, n_buckets)
        keys, trained, every = block.unigrams()
        # As if the corpus were so many times as large.
        replies = [lm.dump(np.arange(hi - lo), trained[lo:hi], every[lo:hi] * n_buckets) for _, lo, hi in lm._runs(lm.bucket_of(keys, n_buckets))]
        block.set_unigrams(replies, facts)
        block.grams(facts)
        sent = list(block.requests())
        assert len(sent) <= len(block.counts) <= 900
        assert sum(len(lm.load(data)[-1]) for _, data in sent) == len(block.counts)
        assert [b for b, _ in sent] == sorted({b for b, _ in sent})
