"""Each operator against a brute-force version, and its defined edge cases."""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import os
import re
import sys
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from medallion.llm import chat, graph, minmax, mixing, pii, planes, seeds, suffixes, tokens, topk, toxicity, warc
from medallion.llm.words import shared, shingles, split_words, word_hashes
from medallion.session import ship_package
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, node string, rep long, size long, x double, part int"
ODD_TEXTS = [None, "", "   ", "a", "one two three", "é😀 ß\n\tx", "word " * 30000]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def odd_docs(spark):
    """Null, empty, blank, short and long texts, repeated rows and ids, null ids, clashing names."""
    rows = [(i, t, None if i % 2 else "s", "n", 1, 2, 0.5, 3) for i, t in enumerate(ODD_TEXTS)]
    return spark.createDataFrame([*rows, rows[4], (4, "other text here", "s", *rows[0][3:]), (None, "a", None, *rows[0][3:])], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


# 1 chat

CONV = "conv_id long, turn long, role string, text string, node string, path string"


def said(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], CONV)


def read_back(spark, rows):
    path = tokens.tokenizer_file()
    nodes, paths = chat.format_trees(said(spark, rows), path)
    return nodes, chat.read_conversations(nodes, paths, path).toPandas()


def test_chat_reads_back_and_shares_beginnings(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"turn {t}" if t < 2 else f"turn {t} of {i % 3}") for i in range(6) for t in range(4)]
    rows += [(50, 0, None, None), (50, 0, None, None), (None, 1, "assistant", "\\<turn> </turn>\n \\n <|endoftext|> é"), (51, None, "a\nb", "<turn>")]
    nodes, found = read_back(spark, rows)
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)), key=lambda r: r[0]):
        own = list(own)
        line = found[found.conv_id.isna() if conv is None else found.conv_id == conv].iloc[0]
        text = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        learnt = "".join(t or "" for _, _, r, t in own if r == "assistant")
        assert (line.n_turns, line.loss_chars) == (len(own), len(learnt))
        assert line.turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert line.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
    flat = nodes.toPandas()
    assert len(flat) == 2 + 3 * 2 + 2 + 1 + 1
    for _, tree in flat.groupby("tree"):
        tree = tree.sort_values("start")
        lengths = tree.ids.map(len).to_numpy()
        assert tree.start.tolist() == (np.cumsum(lengths) - lengths).tolist()
        by_node = {n.node: n for n in tree.itertuples()}
        for n in tree.itertuples():
            seen, up = set(), n.parent
            while up is not None:
                seen |= set(range(by_node[up].start, by_node[up].start + len(by_node[up].ids)))
                up = by_node[up].parent
            assert seen == {i for a in n.attention for i in range(a["start"], a["end"])}
            assert list(n.position_ids) == list(range(len(seen), len(seen) + len(n.ids)))


def test_chat_of_no_rows(spark):
    nodes, found = read_back(spark, [])
    assert nodes.count() == 0 and len(found) == 0


@given(st.text(alphabet="\\<>/turn\nax"))
def test_escapes_reverse(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.unescape(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)
    assert not re.search(r"(?<!\\)</?turn>", chat.escape(text).replace("\\\\", ""))


# tokens

@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Bc", " ", "  ", "\n", "'s", "'", "é", "12", ".", "!", "\t", "\x1c", "中", "<|endoftext|>", "²", "़"]), max_size=14))
def test_remembered_pieces_give_the_library_s_ids(parts):
    text = "".join(parts)
    encoder = tokens.encoder(tokens.tokenizer_file())
    expected = encoder.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected
    small = tokens.Encoder(tokens.tokenizer_file(), kept=5) if len(parts) == 14 else encoder
    assert np.frombuffer(small.encode_many([text, "a b", text])[2], "<u4").tolist() == expected


def test_words_of_plain_letters_are_not_searched_for_odd_ones(monkeypatch):
    encoder, searched, odd = tokens.Encoder(tokens.tokenizer_file()), [], tokens._ODD

    class Watched:
        def search(self, word):
            searched.append(word)
            return odd.search(word)

    monkeypatch.setattr(tokens, "_ODD", Watched())
    texts = ["plain words, (as here)\nended: so.\nand so!? a_b end_", "naïve x1, a<|b|> c<| it's", "\nplain. <| .", "ended, don't"]
    for text, ids in zip(texts, encoder.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids
    assert {"naïve", "x1,", "a<|b|>", "c<|"} <= set(searched)
    assert not {"words,", "\nended:", "so.", "\nplain.", "ended,"} & {*searched, *("\n" + w for w in searched)}


def test_words_of_one_piece_are_not_cut_again():
    encoder, cut = tokens.Encoder(tokens.tokenizer_file()), []
    library = encoder.library

    class Watched:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode_batch_fast(self, lines, **kwargs):
            cut.extend(lines)
            return library.encode_batch_fast(lines, **kwargs)

    encoder.library = Watched()
    texts = ["Plain words\nnaïve, 中文 über: unusualwordsofletters", "plain\nplain x1 it's (a) b2b", " ".join(f"w{chr(97 + k % 26)}" * (k % 9 + 1) for k in range(999))]
    for text, ids in zip(texts, encoder.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    seen = set("\n".join(cut).replace("\n", " ").split())
    assert {"x1", "it's", "(a)", "b2b"} <= seen
    assert not {"Plain", "words", "naïve", "中文", "über", "unusualwordsofletters", "plain", "wa"} & seen


def test_what_is_kept_is_counted_by_what_it_takes():
    encoder = tokens.Encoder(tokens.tokenizer_file())
    encoder.encode(" ".join(a + b + c + d for a, b, c, d in itertools.product("thrnsaeiou", repeat=4)))
    up = [(sys.getsizeof(v) + 15) // 16 * 16 for pair in encoder.words.items() for v in pair]
    takes = sum(up) + sys.getsizeof(encoder.words)
    assert len(encoder.words) > 9_000 and takes <= encoder.held <= 1.4 * takes


# 2 toxicity

def test_toxicity_held_out_accuracy(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    model = toxicity.train(read("documents"), read("labels"))
    found = toxicity.score(read("documents"), model).where(toxicity.held_out()).join(read("labels"), "doc_id").toPandas()
    clean, toxic = found[found.toxic == 0], found[found.toxic == 1]
    assert (clean.predicted == 0).mean() > 0.95 and (toxic.predicted == 1).mean() > 0.5
    assert all(len(s) for s in found[found.predicted == 1].sentences)


def test_toxicity_learns_sentences_from_document_labels():
    clean = [(f"plain words number {i}. More of them.".encode(), 0) for i in range(40)]
    toxic = [(f"plain words number {i}. You vile blorg. More.".encode(), 1) for i in range(40)]
    model = toxicity.fit(clean + toxic)
    text = "é plain words. you vile blorg. More of them.".encode()
    score, sentences = model.score(text)
    assert score > 0.9 and len(sentences) == 1
    start, end, _ = sentences[0]
    assert text.decode()[start:end].strip() == "you vile blorg."
    assert model.score(b"plain words. " * 5000)[0] < 0.5


def test_long_clean_prose_is_not_toxic():
    read = lambda t: pq.read_table(f"/root/testdata/sf0.01/{t}.parquet").to_pydict()
    docs, labels = read("documents"), read("labels")
    toxic = dict(zip(labels["doc_id"], labels["toxic"]))
    known = [(t.encode(), toxic[i]) for i, t in zip(docs["doc_id"], docs["text"]) if toxic.get(i) in (0, 1)]
    model = toxicity.fit(known)
    insults = b"idiot clown worthless loser scum disgusting moron stupid pathetic trash".split()
    clean = [w for t, y in known if not y for w in t.split() if not any(i in w.lower() for i in insults)]
    rng = np.random.default_rng(2)
    words = [clean[i] for i in rng.integers(0, len(clean), 350_000)]
    prose = b" ".join(w + b"." if i % 12 == 11 else w for i, w in enumerate(words))
    assert len(prose) > 2_000_000
    score, offending = model.score(prose)
    assert score < toxicity.THRESHOLD and not offending
    assert model.score(b"These are plain words. " * 100_000)[0] < toxicity.THRESHOLD
    worst = b" You worthless idiot, stupid moron, pathetic scum, disgusting trash. "
    assert model.score(prose + worst)[0] > toxicity.THRESHOLD
    pieces = np.concatenate([g for g, _ in toxicity.grams(prose)])
    data = b" " + prose.lower().translate(toxicity._PLAIN) + b" " * 6
    assert len(pieces) == 2 * (len(prose) + 1)
    last = toxicity._PIECE - 1
    assert int(pieces[last]) == int.from_bytes(data[last : last + 5], "little") | 5 << 56


def test_toxicity_sample_is_bounded_by_bytes(spark, monkeypatch):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1][:40]
    long = "plain words. " * 20_000
    rows = [(i, long if i == ids[0] else f"plain words of {i}." + " vile blorg." * (i % 2)) for i in ids]
    rows += [(ids[1], f"{rows[1][1]} again {k}") for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda sample: seen.append(sample))
    toxicity.train(df, labels)
    assert sorted(seen[0]) == sorted((t.encode(), i % 2) for i, t in rows[:40])
    toxicity.train(df, labels, sample_bytes=400)
    for label in (0, 1):
        own = [t for t, y in seen[1] if y == label]
        assert 300 < sum(map(len, own)) <= 400


def test_toxicity_edge_cases(spark):
    rows = odd_docs(spark)
    labels = spark.createDataFrame([(0, 1, 1, "t"), (1, 1, None, "t"), (None, 0, 0, "t")], "doc_id long, quality int, toxic int, text string")
    model = toxicity.train(rows, labels)
    assert toxicity.score(rows, model).where("score between 0 and 1 and predicted = 0").count() == rows.count()
    assert toxicity.without_toxic(rows, model).columns == rows.columns
    assert toxicity.score(empty_docs(spark), model).count() == 0
    assert toxicity.train(empty_docs(spark), labels.limit(0)).score(b"x")[1] == []


# 3 warc

def test_warc_round_trip(spark):
    marked = "x WARC/1.1\r\n y\r\n\r\nWARC/1.1\r\nz"
    rows = [(3, "u", marked), (2, None, marked), (5, "WARC/1.1", "end WARC/1.1"), (6, "a b", None), (7, "", ""), (7, "", ""), (None, "é", "é\r\n\r\n"), (9, "q", "p" * 300000)]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, type string").coalesce(2)
    found = warc.archive_pages(pages).toPandas()
    assert len(found) == len(rows)
    payloads = [((r[2] or "").encode(), r[0]) for r in rows]
    digest = {p: base64.b32encode(hashlib.sha1(p).digest()).decode() for p, _ in payloads}
    assert sorted(found.payload_digest) == sorted(digest[p] for p, _ in payloads)
    assert sorted(found.payload_bytes) == sorted(len(p) for p, _ in payloads)
    for payload, name in digest.items():
        own = found[found.payload_digest == name]
        smallest = min((i for p, i in payloads if p == payload and i is not None), default=None)
        assert (own.record_type == "response").sum() == 1
        assert set(own[own.record_type == "revisit"].refers_to) <= {smallest}
        first = own[own.record_type == "response"].page_id.iloc[0]
        assert first == smallest or smallest is None and first != first
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_warc_joins_ties_of_either_side(spark):
    r = lambda i, t, c: (i, t, None, c, None, None, None, None, None, {})
    records = spark.createDataFrame(
        [r("a", "response", ["q"]), r("q", "request", []), r("m", "metadata", ["q"]), r("n", "metadata", ["a"]), r("z", "metadata", ["nowhere"])],
        warc.RECORDS,
    )
    row = warc.assemble(records).first()
    assert row.record_id == "a" and [x.record_id for x in row.requests] == ["q"]
    assert sorted(x.record_id for x in row.metadata) == ["m", "n"]


def test_warc_refuses_wrong_lengths():
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabcdef\r\n\r\n")


# 4 mixing

def test_mix_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = mixing.mix(docs)
    rows = found.toPandas()
    again = mixing.mix(docs.repartition(3)).toPandas()
    assert rows.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    assert (rows.taken <= 2 * rows["size"]).all() and len(rows) == docs.count()
    words = docs.select("doc_id", "source", "text").toPandas()
    words["n"] = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in words.text]
    both = rows.merge(words, on="doc_id")
    assert (both["size"] == both.n).all()
    per = both.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), given=("source_size", "first"), n=("n", "sum"))
    assert (per.given == per.n).all() and (per.target <= 2 * per.n + 1e-6).all()
    assert abs(per.target.sum() / per.n.sum() - 1.5) < 1e-9
    assert ((per.taken - per.target).abs() / per.target).max() < 0.01
    weight = dict(zip(sorted(per.index), itertools.cycle((3, 1, 2))))
    rates = [t / weight[s] for s, t, n in zip(per.index, per.target, per.n) if t < 2 * n - 1e-6]
    assert max(rates) - min(rates) < 1e-6 * max(rates)


def test_mix_edge_cases(spark):
    rows = odd_docs(spark)
    found = mixing.mix(rows)
    assert found.count() == rows.count() and found.where("taken > 2 * size or taken < 0").count() == 0
    assert mixing.mixed(rows).columns == rows.columns
    assert mixing.mix(empty_docs(spark)).count() == 0


def test_flight_keeps_both_totals():
    draw = np.random.default_rng(1)
    sizes = draw.integers(1, 500, 400).astype(float)
    x = np.full(400, 0.3)
    left = mixing._flight(x, sizes, draw)
    assert len(left) <= 2 and abs(x.sum() - 120) < 1e-6 and abs(x @ sizes - 0.3 * sizes.sum()) < 1e-4


# 5 near duplicates

def brute_components(rows):
    sets = {i: set(shingles(word_hashes(t)).tolist()) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_near_duplicates_equal_brute_force(spark, docs):
    words = [f"w{i}" for i in range(60)]
    family = [(10_000 + k, " ".join(words[:k] + ["x"] + words[k + 1 :])) for k in range(40)]
    chain = [(20_000 + k, " ".join(f"v{i}" for i in range(4 * k, 60 + 4 * k))) for k in range(12)]
    given_docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(family + chain, "doc_id long, text string"))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minmax.near_duplicates(given_docs).collect()}
    assert found == brute_components([tuple(r) for r in given_docs.collect()])


def test_near_duplicate_edge_cases(spark):
    rows = odd_docs(spark)
    found = minmax.near_duplicates(rows).toPandas()
    assert len(found) == rows.count() and found[found.doc_id.isin([0, 1, 2])].kept.all()
    assert found[found.doc_id.isin([0, 1, 2])].n_shingles.tolist() == [0, 0, 0]
    assert found[found.doc_id.isna()].kept.tolist() == [True]
    assert minmax.deduplicated(rows).columns == rows.columns
    assert minmax.near_duplicates(empty_docs(spark)).count() == 0


def test_words_and_shingles():
    assert split_words("A b\x0bC\u00a0d\x1ce") == [b"a", b"b", "c\u00a0d\x1ce".encode()]
    assert len(shingles(word_hashes("a b c"))) == 1 and len(shingles(word_hashes("a b c d e f a b c d e"))) == 6
    assert shared(np.array([1, 3], np.uint64), np.array([2, 3], np.uint64)) == 1


@settings(max_examples=15, deadline=None)
@given(links=st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
def test_components(spark, links):
    up = list(range(13))
    for a, b in links:
        low, high = sorted((up[a], up[b]))
        up = [low if u == high else u for u in up]
    df = spark.createDataFrame([*links, (None, 1)], "a long, b long")
    assert {r.node: r.component for r in graph.components(df).collect()} == {i: u for i, u in enumerate(up) if i != u}


# 6 repeated strings

def brute_removed(rows):
    first, out = {}, []
    rows = sorted(((2**63 if i is None else i), t) for i, t in rows)
    for i, t in rows:
        for at in range(len(t) - 49):
            first.setdefault(t[at : at + 50], i)
    for i, t in rows:
        gone = np.zeros(len(t), dtype=bool)
        for at in range(len(t) - 49):
            if first[t[at : at + 50]] < i:
                gone[at : at + 50] = True
        runs = int((gone & ~np.append(False, gone)[: len(t)]).sum())
        left = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def test_suffix_removal_equals_brute_force(spark, docs):
    rng = np.random.default_rng(6)
    pool = "".join(rng.choice(list("abé "), 400))
    cuts = [(1000 + i, pool[a : a + int(n)]) for i, (a, n) in enumerate(zip(rng.integers(0, 300, 60), rng.integers(10, 200, 60)))]
    extra = [(2000, "a" * 500), (2001, "b" + "a" * 70), (2002, "a" * 49), (None, "a" * 60), (2001, "b" + "a" * 71), (1000, cuts[0][1])]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(cuts + extra, "doc_id long, text string"))
    found = suffixes.without_repeats(rows).collect()
    expected = brute_removed([(r.doc_id, r.text.encode()) for r in rows.collect()])
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == expected
    assert all(hashlib.sha256(r.text).hexdigest() == r.kept_sha256 for r in found)


def test_a_common_line_with_different_tails_fills_no_block(spark, monkeypatch):
    rng = np.random.default_rng(7)
    line = "All rights are reserved by the owners of these pages."
    word = lambda: "".join(rng.choice(list("abcdefgh"), 30))
    rows = [(i, f"{word()} {line}{word() if i % 9 else ' the same end of a line here'}") for i in range(3000)]
    inner = suffixes._transform
    at = f"{tempfile.mkdtemp(prefix='run-')}/blocks"

    def counted(table):
        with open(at, "a") as f:
            f.write(f"{sum(map(len, table.column('segment').to_pylist()))}\n")
        return inner(table)

    monkeypatch.setattr(suffixes, "_transform", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(suffixes, "repeated_spans", functools.partial(suffixes.repeated_spans, block_bytes=20_000, meeting_bytes=2_000))
    found = suffixes.without_repeats(df).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == brute_removed([(i, t.encode()) for i, t in rows])
    sizes = [int(n) for n in open(at)] if os.path.exists(at) else [0]
    assert max(sizes) <= 40_000


def test_segments_name_their_bytes_once_and_travel_pressed():
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    piece = " ".join(rng.choice(words, 3000)).encode()
    known = np.unique(suffixes.anchors(suffixes.packed(piece))[2])
    low, count, key = suffixes.segments_of(piece, known, known[:0])
    windows = np.concatenate([np.arange(a, a + n) for a, n in zip(low, count)])
    assert sorted(windows.tolist()) == list(range(len(piece) - suffixes.LENGTH + 1))
    assert (count + suffixes.LENGTH - 1).sum() <= 5 * count.sum()
    content = [piece[a : a + n + suffixes.LENGTH - 1] for a, n in zip(low.tolist(), count.tolist())]
    frame = suffixes.pack_segments(np.arange(len(low)), low, key, content)
    ids, owners, keys, again = suffixes.unpack_segments(frame)
    assert (ids.tolist(), owners.tolist(), keys.tolist(), again) == (list(range(len(low))), low.tolist(), key.tolist(), content)
    assert len(frame) < sum(map(len, content)) * 3 // 4


def test_joined_texts_have_the_anchors_of_each_alone():
    rng = np.random.default_rng(9)
    values = [bytes(rng.choice(list(b"abcdef "), int(n)).tolist()) for n in [50, 51, 400, 90, 3000, 49, 70]]
    for i, (piece, ends, number, at) in enumerate(suffixes._joined(enumerate(values))):
        first, place, hashes = suffixes.anchors(suffixes.packed(piece), ends)
        inside = place >= 0
        row = np.searchsorted(ends, first, "right")
        begins = np.append(0, ends[:-1])
        assert i == 0 and number.tolist() == [0, 1, 2, 3, 4, 6] and not at.any()
        for k, n in enumerate(number.tolist()):
            own = suffixes.anchors(suffixes.packed(values[n]))
            of = inside & (row == k)
            assert (first[of] - begins[k]).tolist() == own[0].tolist()
            assert (place[of] - begins[k]).tolist() == own[1].tolist() and hashes[of].tolist() == own[2].tolist()


def test_windows_around_crowded_anchors_lie_by_run():
    rng = np.random.default_rng(10)
    line = bytes(rng.choice(list(b"abcdef "), 3000).tolist())
    n = 40
    table = pa.table({"part": pa.array([0] * n, pa.int32()), "ord": pa.array(range(n), pa.int64()), "text": [line] * n, "text_key": pa.array(range(n), pa.int64())})
    known = np.unique(suffixes.anchors(suffixes.packed(line))[2])
    shared = pa.table({"hashes": pa.array([known], pa.list_(pa.int64())), "crowded": pa.array([known], pa.list_(pa.int64()))})
    found = suffixes._segments(3)(table, shared)
    places = found.filter(pc.equal(found.column("block"), suffixes.PLACES))
    windows = n * (len(line) - suffixes.LENGTH + 1)
    assert sum(pc.list_value_length(places.column(c))[0].as_py() for c in ("ids", "documents", "starts", "cells")) < windows // 4
    frames = found.filter(pc.greater_equal(found.column("block"), 0))
    answers = suffixes._in_block(suffixes._transform, suffixes.BLOCK_BYTES)(frames)
    spans = suffixes._spans(places, answers).to_pylist()
    assert spans == [{"ord": i, "text_key": i, "start": 0, "end": len(line)} for i in range(1, n)]


def test_suffix_edge_cases(spark):
    rows = odd_docs(spark)
    assert suffixes.without_repeats(rows).where("n_removed > 0").count() == 0
    assert suffixes.without_repeats(rows).count() == rows.count()
    assert suffixes.without_repeats(empty_docs(spark)).count() == 0


def test_intervals_find_common_prefixes():
    rng = np.random.default_rng(3)
    segments = [bytes(rng.choice(list(b"ab"), 70, p=[0.9, 0.1]).tolist()) for _ in range(30)]
    found = suffixes.smallest_owners(segments, np.arange(30))
    for i, s in enumerate(segments):
        assert found[i].tolist() == [min(j for j, t in enumerate(segments) if s[a : a + 50] in t) for a in range(21)]


# 7 planes

@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.booleans())
def test_planes_reverse(ids, bits):
    ids = np.array(ids, dtype="<u4")
    assert planes.unpack_block(memoryview(planes.pack_block(ids, bits))).tolist() == ids.tolist()


def test_token_files_read_back(spark, docs):
    from medallion.session import work_dir

    rows = odd_docs(spark).select("doc_id", "text").unionByName(docs.select("doc_id", "text").withColumn("doc_id", F.col("doc_id") + 100))
    path = work_dir(spark, "tokens")
    planes.write(rows, path, tokens.tokenizer_file(), bits=True, file_bytes=20_000)
    found = planes.read_documents(spark, path).orderBy("start").collect()
    library = tokens.encoder(tokens.tokenizer_file()).library
    given_rows = sorted((r.doc_id is not None, r.doc_id or 0, (r.text or "").encode(), r.text or "") for r in rows.collect())
    at = 0
    assert len(found) == len(given_rows)
    for (known, doc_id, _, text), row in zip(given_rows, found):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert row.doc_id == (doc_id if known else None)
        assert (row.start, row.n_tokens) == (at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)


def test_token_files_of_a_hot_id_and_of_none_are_cut(spark, docs):
    from medallion.session import work_dir

    third = F.when(F.col("doc_id") % 3 == 0, 7).when(F.col("doc_id") % 3 == 1, F.col("doc_id")).cast("long")
    rows, path = docs.select(third.alias("doc_id"), "text"), work_dir(spark, "tokens")
    planes.write(rows, path, tokens.tokenizer_file(), file_bytes=20_000)
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert len(sizes) > 10 and max(sizes) < 0.35 * sum(sizes)
    found = planes.read_documents(spark, path)
    assert found.groupBy("doc_id").count().where("doc_id = 7 OR doc_id IS NULL").count() == 2
    tokens_of = lambda t: tokens.encoder(tokens.tokenizer_file()).encode(t or "")
    assert found.agg(F.sum("n_tokens")).first()[0] == sum(len(tokens_of(r.text)) // 4 + 1 for r in rows.collect())


def test_token_files_of_no_rows(spark):
    assert planes.token_files(empty_docs(spark), tokens.tokenizer_file()).count() == 0


# 8 personal data

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    def fine(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(t - 9 * (t > 9) for t in twice) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in RULES.items() for m in re.finditer(p, text) if fine(k, m[0])]


def test_base_spans_equal_plain_rules(spark, docs):
    rng = np.random.default_rng(8)
    parts = ["1", "22", "+1", " ", "-", "(555)", "a", "b.c", "@", "d.e", ".", "4111111111111111", "4111 1111 1111 1111", "é", "😀", "300.1.2.3", "1.2.3.4", "_", "+49 30 1234567", "\n"]
    mixed = [(10_000 + i, "".join(rng.choice(parts, rng.integers(0, 20)))) for i in range(600)]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([*mixed, (20_000, None)], "doc_id long, text string"))
    trees = pii.train(docs)
    text = {r.doc_id: r.text or "" for r in rows.collect()}
    for row in pii.spans(rows, trees).collect():
        base = plain_base(text[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, row.spans.split(",")))
        assert row.n_email == sum(b.startswith("email") for b in base)


def test_base_spans_without_runs_of_digits(spark):
    alone = ["+33 1 23 45 67 89", "+1 2 3 4 5 6 7 8", "+12.34.56.78", "411 111 111 111 111 1", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "41 11 11 11 11 11 11 11", "a@b.c", "1.2.3.4"]
    rows = [(2 * i + j, text) for i, t in enumerate(alone) for j, text in enumerate((t, f"call {t} or so"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.spans(df, None).collect()}
    for doc_id, text in rows:
        base = plain_base(text)
        assert base and found[doc_id].spans == ",".join(base)
        assert found[doc_id].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    assert all(not re.search("[0-9]", r.text) for r in pii.redacted(df, None).collect())


def test_long_runs_need_no_stack(spark):
    long = [(1, "1 " * 20000), (2, "x@" + "a." * 20000 + "b"), (3, "+" + "1" * 50000), (4, "a" * 100000)]
    assert pii.spans(spark.createDataFrame(long, "doc_id long, text string"), None).count() == 4


def test_pii_edge_cases(spark):
    assert pii.train(empty_docs(spark)) is None
    rows = odd_docs(spark)
    assert pii.spans(rows, None).where("spans = ''").count() == rows.count()
    assert pii.spans(empty_docs(spark), None).count() == 0
    text = spark.createDataFrame([(1, "é a@b.cd, 10.0.0.1!")], "doc_id long, text string")
    assert pii.redacted(text, None).first().text == "é [email], [ip]!"


# 9 top k

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(size=4).round(1)], "v") for i in range(300)]
    rows += [(i + 300, rows[0][1], "v") for i in range(40)]
    odd = [(900, None, "v"), (None, [1.0] * 4, "v"), (901, [float("nan")] * 4, "v"), (902, [None, 1.0, 1.0, 1.0], "v"), (903, [1.0] * 3, "v"), (904, [float("inf")] * 4, "v")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score string")
    found = topk.top_k(df.where("vec_id % 20 = 0"), df, 20)
    scaled = {i: np.floor(64 * np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows}
    expected = []
    for q in (i for i in scaled if i % 20 == 0):
        best = sorted((-int(scaled[q] @ v), i) for i, v in scaled.items() if i != q)[:20]
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    assert topk.top_k(df.limit(0), df, 20).count() == 0


def test_products_beyond_doubles():
    big = np.array([[2.0**40, 1.0]])
    assert topk.products(big, big)[0, 0] == topk._LONG
    assert topk.products(np.array([[2.0**30, 1.0]]), np.array([[2.0**30, 1.0]]))[0, 0] == 2**60 + 1


# 10 decontamination

def test_masks_find_one_substitution_in_fifteen_words_and_two_in_twenty():
    for length, changes in ((15, 1), (20, 2)):
        for spots in itertools.combinations(range(length), changes):
            hit = any(
                all(m[i] == "0" or at + i not in spots for i in range(len(m)))
                for m in seeds.MASKS for at in range(length - len(m) + 1)
            )
            assert hit, (length, spots)


def test_contaminated_documents(spark, docs):
    item = " ".join(f"w{i}" for i in range(20))
    words = item.split()
    changed = " ".join("other" if i in (4, 13) else w for i, w in enumerate(words))
    rows = [
        (1, f"before {item.upper()}, after"), (2, f"x {changed} y"), (3, " ".join(words[:8])), (4, " ".join(reversed(words))),
        (5, None), (6, ""), (7, "one two three, four five six"), (8, " ".join(words[3:18])), (1, f"before {item.upper()}, after"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, None, 0), (3, "one two three four five six", 0), (4, "a b", 0), (None, "", 0)], "item_id long, text string, doc_id int")
    found = sorted((r.doc_id, r.item_id, r.matched) for r in seeds.contaminated(df, items).collect())
    assert found == [(1, 1, 20), (1, 1, 20), (2, 1, 18), (7, 3, 6), (8, 1, 15)]
    assert sorted(r.doc_id for r in seeds.decontaminated(df, items).collect()) == [3, 4, 5, 6]
    many = [dict(b) for b in seeds.item_blocks(items, 5)]
    assert sum(map(len, many)) >= 4
    assert seeds.contaminated(empty_docs(spark), items).count() == seeds.contaminated(df, items.limit(0)).count() == 0


def test_contaminated_equals_brute_force(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    plain = lambda t: " " + " ".join(re.sub(r"[!-/:-@\[-`{-~]", "", t.lower()).split()) + " "
    items = {r.item_id: plain(r.text) for r in read("benchmark").collect()}
    whole = {(r.doc_id, i) for r in read("documents").collect() for i, t in items.items() if t in plain(r.text)}
    assert whole == {(r.doc_id, r.item_id) for r in seeds.contaminated(read("documents"), read("benchmark")).collect()}
