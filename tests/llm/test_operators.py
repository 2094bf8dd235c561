"""Each operator against its plain version, on a small table with every odd case and on the test tables."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from airseries.llm import (
    automaton,
    common,
    decontaminate,
    line_dedup,
    lm_score,
    packing,
    quality_model,
    quality_rules,
    simhash,
    substring_dedup,
    token_counts,
    tokens,
    url_filter,
)

SF = "/root/testdata/sf0.001"

RNG = random.Random(11)
VOCABULARY = ["the", "Of", "été", "日本", "x", "AND", "a-b", "zeta", "naïve", "$5", "run", "###"]
PROSE = [" ".join(RNG.choice(VOCABULARY) for _ in range(60)) for _ in range(6)]
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t\r "),
    (4, "one"),
    (5, "one\nthe same long line here\n\none"),
    (6, "The Same long LINE here \nother\n"),
    (7, PROSE[0]),
    (7, PROSE[0]),  # a row repeated
    (7, PROSE[1]),  # an id repeated with another text
    (8, PROSE[0]),
    (9, PROSE[2] + "\n" + PROSE[0] + " tail"),
    (10, "again " * 300),
    (11, " ".join(RNG.choice(VOCABULARY) for _ in range(30_000))),
    (None, PROSE[3]),
    (12, PROSE[3] + " \u00a0 end<|endoftext|>"),
    (13, PROSE[4].upper()),
    (14, PROSE[4]),
    (15, "\x1c\x00 odd \x85 bytes"),
]
#: Columns of every table come with names that operators use inside or return.
CLASHES = """id doc row key pos line chunk train text_key words hashes n_words n_lines n_dropped lines_changed score
kept llr fingerprint component_id print node root tree n_tokens n_hit hit_items clean_text covered held_out
predicted start length sequence_id host path rule verdict short digest label number_0 __text __0 __doc __row __drops
__lines __id __key __host __path __won __score __hits __items __longest n_dropped_ covered_ own_n_lines""".split()


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    common.reach_workers(spark)


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    plain = rows.withColumn("n_chars", F.when(F.col("doc_id") != 9, F.length("text").cast("long")))
    for name in CLASHES:
        plain = plain.withColumn(name, F.lit("clash"))
    return plain


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def same(got, want):
    return sorted(map(repr, got)) == sorted(map(repr, want))


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


# --- op1


def check_scores(docs, rows, learned, depth):
    tree = brute.ContextTree([t for d, t in docs if learned(d)], depth)
    want = brute.unigram(docs, learned)
    by_key = defaultdict(list)
    for r in rows:
        by_key[r.doc_id].append(r)
    for (doc, text), (n, known, total, base) in zip(docs, want, strict=True):
        score = tree.log10(text)
        assert any(
            (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, not learned(doc))
            and r.base_score == pytest.approx(base, rel=1e-9)
            and r.score == pytest.approx(score, rel=1e-5)
            for r in by_key[doc]
        ), (doc, text)
    assert len(rows) == len(docs)


@pytest.mark.parametrize("depth,chunk_bytes", [(3, 100), (5, 1 << 20)])
def test_scores_of_odd_rows(spark, odd, depth, chunk_bytes):
    learned = lambda d: d is not None and d % 3 != 0
    got = lm_score.language_scores(odd, F.col("doc_id") % 3 != 0, depth=depth, chunk_bytes=chunk_bytes)
    small = [(d, t) for d, t in ODD if d != 11]
    tiny = lm_score.language_scores(
        odd.where("doc_id is null or doc_id <> 11"), F.col("doc_id") % 3 != 0, depth=depth, chunk_bytes=chunk_bytes
    )
    check_scores(small, tiny.collect(), learned, depth)
    assert got.count() == len(ODD)


def test_scores_without_training_rows(spark, odd):
    row = lm_score.language_scores(odd.where("doc_id = 4"), F.lit(False)).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 2, 0, 0)
    assert row.score == pytest.approx(-8 * 4 * np.log10(2)) and row.base_score == 0.0
    assert lm_score.language_scores(odd.limit(0), F.lit(True)).count() == 0


def test_scores_of_documents(spark):
    docs = documents(spark)[:40]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = lm_score.document_scores(df).collect()
    check_scores(docs, rows, lambda d: brute.crc(d) % 10 != 0, 6)


@pytest.mark.parametrize("depth,share", [(3, 10**9), (6, 10**9), (6, 1), (6, 40), (7, 300)])
def test_hot_contexts_change_nothing(spark, monkeypatch, depth, share):
    """From no hot context to every context that occurs being worked on by all its bytes."""
    monkeypatch.setattr(lm_score, "HOT_SHARE", share)
    docs = [(d, t[:600]) for d, t in documents(spark)[:25]] + [(90, "aaaa " * 40), (91, None), (92, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lm_score.language_scores(df, F.col("doc_id") % 3 != 0, depth=depth, chunk_bytes=3000)
    check_scores(docs, got.collect(), lambda d: d % 3 != 0, depth)


def test_no_route_holds_a_hot_context(spark):
    """Contexts that precede more than their share of all bytes are dealt out by more bytes."""
    text = "na na na ma na nb nc nd " * 50
    placed = spark.createDataFrame([(text.encode(), 0)], "text binary, chunk long")
    hot = lm_score.hot_contexts(placed, 6, 1)
    assert set(hot) == {2, 3, 4, 5}
    keys = np.unique(lm_score.part_grams(lm_score.parts_of([text.strip().encode()])[0], 6)[0])
    sizes = lm_score.shared_bytes(keys, 6, hot)
    assert sizes.min() >= 2 and sizes.max() == 6
    for size in (2, 3, 4, 5):
        at = lm_score.prefix_of(keys, 6, size)
        assert np.array_equal((sizes > size)[sizes >= size], np.isin(at, hot[size])[sizes >= size])


# --- op2


@pytest.mark.parametrize("window,chunk_bytes", [(6, 60), (8, 1 << 20), (13, 500)])
def test_passages_of_odd_rows(odd, window, chunk_bytes):
    got = substring_dedup.dedup_passages(odd, window=window, chunk_bytes=chunk_bytes, shard_bytes=500)
    have = [(r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in got.collect()]
    assert same(have, brute.passages(ODD, window))
    assert substring_dedup.dedup_passages(odd.limit(0)).count() == 0


def test_automaton_tells_the_first_owner():
    random_ = random.Random(3)
    for _ in range(300):
        tree, added = automaton.SuffixAutomaton(), []
        for owner in range(random_.randint(1, 6)):
            text = [random_.randint(0, 2) for _ in range(random_.randint(1, 12))]
            size = random_.randint(1, 4)
            want = [
                next((o for o, s in added if any(s[j : j + size] == text[i : i + size] for j in range(len(s)))), None)
                for i in range(len(text) - size + 1)
            ]
            assert tree.firsts(text, size, None) == want
            tree.add(text, owner)
            added.append((owner, text))


# --- op3


URLS = [
    "http://www.Example.com/en/1?x#y", "https://example.com/en/", "http://a.example.com/fr/", "ftp://net/es/1",
    "http://x.net/es", "http://x.net/fr/a/b", None, "", "no scheme", "http://", "http://com", "http://com/",
    "http://a.com?x=/en/", "http://xcom/", "http://a://b.net/es/", "HTTP://Ünï.NET/fr/\nz", "http://notexample.com/en/",
]


def brute_url(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = brute.lower(rest[:end]), rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = []
    for verdict, rule in rules:
        own, prefix = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == own or host.endswith("." + own)) and path.startswith(prefix):
            fits.append((len(rule), len(own), verdict == "block", rule, verdict))
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return url, host, path, best[3], best[4]


def test_urls(spark):
    rules = [*url_filter.PAGE_RULES, ("block", "com/e"), ("allow", "com/e"), ("block", "b.net/es/x")]
    table = url_filter.rules_frame(spark, [*rules, (None, "com/"), ("block", "norule")])
    pages = spark.createDataFrame([(u,) for u in [*URLS, *URLS[:3]]], "url string")
    for name in CLASHES:
        pages = pages.withColumn(name, F.lit("clash"))
    got = url_filter.judge_urls(pages, table)
    rules.remove(("allow", "com/e"))
    want = [brute_url(u, rules) for u in [*URLS, *URLS[:3]]]
    assert same(rows_of(got, "url", "host", "path", "rule", "verdict"), want)
    none = url_filter.judge_urls(pages, url_filter.rules_frame(spark, [("block", "zz/")]).limit(0))
    assert {r.verdict for r in none.collect()} == {"allow"} and none.count() == len(want)
    assert url_filter.judge_urls(pages.limit(0), table).count() == 0


# --- op4


ITEMS = [
    (1, " ".join(PROSE[0].split()[5:30])), (1, " ".join(PROSE[0].split()[5:30])), (2, PROSE[1]), (3, None), (4, ""),
    (5, "one"), (6, "same LONG line"), (None, PROSE[2]), (7, "?!"), (8, PROSE[4]), (10, "again again"),
]


@pytest.mark.parametrize("shard_words", [4_000_000, 40])
def test_contamination_of_odd_rows(spark, odd, shard_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.decontaminate(odd, items, keep=["doc_id"], shard_words=shard_words)
    have = [
        (r.doc_id, r.n_words, r.n_hit, len(r.hit_items), brute.sha(",".join(r.hit_items)), r.n_hit > 0)
        for r in found.collect()
    ]
    assert same(have, brute.contamination(ODD, ITEMS))
    assert decontaminate.decontaminate(odd.limit(0), items).count() == 0
    clean = decontaminate.decontaminate(odd, items.limit(0), keep=["doc_id", "text"])
    assert all(r.clean_text == r.text and r.n_hit == 0 for r in clean.collect())


def test_cut_spans_keeps_the_rest():
    text = b"Ab,  cd! ef\n\xc3\xa9g  (hi)"
    hits = np.array([False, True, True, False, True])
    assert decontaminate.cut_spans(text, hits) == b"Ab,  \n\xc3\xa9g  ()"


# --- op5


def check_packing(docs, rows, capacity=1024):
    ids_of = {}
    for _, text in docs:
        ids_of[text] = np.array([*tokens.encode_plain(text or ""), 0], "<u4")
    want = sorted((repr(d), len(ids_of[t])) for d, t in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_sequence[r.sequence_id].append(r)
    texts = defaultdict(list)
    for d, t in docs:
        texts[d, len(ids_of[t])].append(ids_of[t])
    for key, own in by_doc.items():
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in own)
        expect = []
        for ids in texts[key]:
            cuts = sorted({s for s, _, _ in pieces} | {len(ids)})
            if len(texts[key]) == 1:
                assert cuts[0] == 0
                expect += [(a, b - a, zlib.crc32(ids[a:b].tobytes())) for a, b in zip(cuts, cuts[1:], strict=False)]
        if expect:
            assert pieces == sorted(expect)
        assert sum(n for _, n, _ in pieces) == sum(map(len, texts[key]))
    total = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
        total += at
    assert total == sum(n for _, n in want)
    return total / (capacity * len(by_sequence))


def test_packing_of_odd_rows(odd):
    check_packing(ODD, packing.pack(odd).collect())
    assert check_packing(ODD, packing.pack(odd, capacity=64).collect(), 64) > 0.9
    assert packing.pack(odd.limit(0)).count() == 0


def test_packing_is_tight(spark):
    rows = contract.queries()["op5_packing"](spark, SF).collect()
    assert check_packing(documents(spark), rows) > 0.99


def test_pieces_balance_cost():
    lengths = np.array([900, 800, 30, 20, 500, 400, 130, 2500])
    pieces = packing.balance(lengths, 1024)
    assert sum(n for _, _, n, _, _ in pieces) == lengths.sum()
    assert len({s for *_, s, _ in pieces}) == 2 + -(-int((lengths % 1024).sum()) // 1024)


def test_ids_equal_those_of_tokenizers():
    parts = ["a", "The", " ", "  ", "\n", "\t", "é", "ß", "日本", "'s", "12", "!!", "#", "<|endoftext|>", "\x1d", "\u00a0",
             ".", "\r\n", " x"]
    random_ = random.Random(5)
    for _ in range(300):
        texts = ["".join(random_.choice(parts) for _ in range(random_.randint(0, 25))) for _ in range(3)]
        ids, ends = tokens.encode_texts([t.encode() for t in texts])
        for i, text in enumerate(texts):
            assert ids[ends[i] : ends[i + 1]].tolist() == tokens.encode_plain(text)


# --- op6


def test_quality_of_odd_rows(spark, odd):
    repeated = [(20, PROSE[0] + " " + PROSE[0]), (21, "\n".join(PROSE[:3] + PROSE[:2] + [""]) + "\n#|$ x")]
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(repeated, "doc_id long, text string"))
    labels = spark.createDataFrame([(7,), (9,), (None,), (7,)], "doc_id long")
    got = quality_rules.judge_quality(docs, labels).collect()
    have = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
    ]
    assert same(have, [(d, *brute.quality(t)) for d, t in [*ODD, *repeated]])
    assert all(r.kept == (not r.base_failed and r.llr >= -0.15) for r in got)
    none = quality_rules.judge_quality(docs, labels.limit(0)).collect()
    assert {r.llr for r in none} == {0.0}
    assert quality_rules.judge_quality(docs.limit(0), labels).count() == 0


def test_ratio_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "c d"), (3, "a b")], "doc_id long, text string")
    buckets = 64
    got = quality_rules.judge_quality(docs, docs.where("doc_id = 1"), buckets=buckets).collect()
    hashed = docs.select(
        "doc_id", quality_rules.ngram_buckets(quality_rules.hashes_of(quality_rules.words_of(F.col("text"))), buckets).alias("b")
    ).collect()
    raw = np.bincount([b for r in hashed for b in r.b], minlength=buckets) + 1
    target = np.bincount([b for r in hashed if r.doc_id == 1 for b in r.b], minlength=buckets) + 1
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    want = {r.doc_id: float(np.mean([ratio[b] for b in r.b])) for r in hashed}
    assert {r.doc_id: r.llr for r in got} == pytest.approx(want, abs=1e-5)


def test_quality_rules_stay_native(spark):
    plan = contract.queries()["op6_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_dedup_stays_native(spark):
    plan = contract.queries()["op10_line_dedup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- op7


def test_counts_follow_edits(spark, odd):
    encoder, _ = tokens.fast_encoder()
    base = token_counts.count_tokens(odd)
    assert {r.n_tokens for r in base.where("doc_id = 2").collect()} == {0}
    edits = [
        (7, 0, 3, "new start"), (7, 10, 0, " inserted"), (7, 40, 1, None), (7, 41, 5, "é"), (9, 100, 50, ""),
        (9, 120, 5, "overlaps"), (9, 10**9, 1, "beyond"), (4, 3, 0, " more"), (2, 0, 0, "first"), (1, 0, 0, "into null"),
        (10, 6, 600, None), (99, 0, 1, "no such row"), (8, None, 1, "x"), (None, 0, 1, "Z"),
    ]
    frame = spark.createDataFrame(edits, "doc_id long, start long, length long, replacement string")
    keep = ["doc_id", "host"]
    done = token_counts.recount(token_counts.attach_edits(base, frame), keep)
    assert done.columns[:2] == keep
    got = done.collect()
    assert len(got) == len(ODD)
    want = []
    for doc, text in ODD:
        body = (text or "").encode()
        out, at, done, n = [], 0, 0, 0
        for _, start, length, new in sorted(
            (e for e in edits if e[0] == doc and e[1] is not None), key=lambda e: (e[1], e[2])
        ):
            inside = body[start : start + 1] + body[start + length : start + length + 1]
            if start < done or start + length > len(body) or any(0x80 <= b < 0xC0 for b in inside):
                continue
            out += [body[at:start], (new or "").encode()]
            at = done = start + length
            n += 1
        new_text = b"".join([*out, body[at:]]).decode()
        shown = new_text if n else text
        want.append((doc, shown, n, len(encoder.encode_ordinary(text or "")), len(encoder.encode_ordinary(new_text))))
    assert same([(r.doc_id, r.text, r.n_edits, r.tokens_before, r.n_tokens) for r in got], want)
    again = [token_counts.TokenTree.unpack(r.tree) for r in got]
    assert [t.n_tokens for t in again] == [r.n_tokens for r in got]
    long = next(r for r in got if r.doc_id == 10)
    assert 0 < long.encoded_bytes < 60
    none = token_counts.attach_edits(base, frame.limit(0))
    assert token_counts.recount(none, keep).where("n_edits > 0").count() == 0
    assert token_counts.recount(none.limit(0), keep).count() == 0


def test_masked_counts(spark):
    encoder, _ = tokens.fast_encoder()
    docs = dict(documents(spark))
    for r in contract.queries()["op7_token_counts"](spark, SF).collect():
        body = docs[r.doc_id].encode()
        found = sorted((m.start(), k, m.end(), new) for k, (p, new) in enumerate(token_counts.MASKS) for m in p.finditer(body))
        out, at = [], 0
        for start, _, end, new in found:
            if start >= at:
                out += [body[at:start], new]
                at = end
        text = b"".join([*out, body[at:]]).decode()
        assert r.text_sha256 == brute.sha(text)
        assert (r.tokens_before, r.tokens_after) == tuple(
            len(encoder.encode_ordinary(t)) for t in (docs[r.doc_id], text)
        )


# --- op8


def test_machine_equals_all_pairs():
    random_ = np.random.default_rng(1)
    machine = quality_model.Machine(0.3, random_.normal(size=50), random_.normal(size=(50, 4)), 20)
    features, values = np.array([3, 7, 30, 41]), np.array([0.5, 0.2, 1.0, 1.0])
    margin = 0.3 + machine.weights[features] @ values
    for i in range(4):
        for j in range(i):
            margin += machine.factors[features[i]] @ machine.factors[features[j]] * values[i] * values[j]
    first = 1 / (1 + np.exp(-(0.3 + machine.weights[3] * 2)))
    got = machine.score([(np.array([3]), np.array([2.0])), (features, values)])
    assert got == pytest.approx([first, 1 / (1 + np.exp(-margin))])


def test_classifier_on_odd_rows(spark, odd):
    labels = spark.createDataFrame(
        [(d, d % 2) for d in range(1, 16)] + [(3, None), (None, 1), (4, 1)], "doc_id long, quality int"
    )
    machine = quality_model.train(odd, labels)
    got = quality_model.score(odd, machine, ["doc_id", "score", "host"])
    assert got.columns == ["doc_id", "host", "score"] and got.count() == len(ODD)
    assert all(0 < r.score < 1 for r in got.collect())
    blank = quality_model.train(odd, labels.limit(0))
    assert {r.score for r in quality_model.score(odd, blank, ["doc_id"]).collect()} == {0.5}
    everything = quality_model.score(odd, machine, odd.columns, score_col="probability")
    assert everything.columns == [*odd.columns, "probability"]
    assert {r["__text"] for r in everything.collect()} == {"clash"}
    assert quality_model.score(odd.limit(0), machine, ["doc_id"]).count() == 0


def test_examples_are_bounded_in_rows(spark, monkeypatch):
    rows = [(1, f"word{i % 40} and more") for i in range(3000)] + [(2, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    taught = []

    def fit(examples, *rest):
        taught.append(len(examples))
        return quality_model.Machine(0.0, np.zeros(1), np.zeros((1, 1)), 1)

    monkeypatch.setattr(quality_model, "fit", fit)
    quality_model.train(docs, labels, max_examples=1)
    quality_model.train(docs, labels, max_examples=7)
    quality_model.train(docs, labels)
    # Equal rows are one example: 40 texts of one id and one of the other.
    assert taught == [1, 7, 41]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = contract.queries()["op8_quality_classifier"](spark, sf).collect()
    held = [(r.score, quality[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in quality]
    good, bad = [s for s, y, _ in held if y], [s for s, y, _ in held if not y]
    assert len(good) > 20 and len(bad) > 3
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([p for _, y, p in held if y]) > 0.97


# --- op9


def test_masks_cover_every_pair_within_the_radius():
    random_ = random.Random(2)
    for radius in (1, 2, 4):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(500):
            change = sum(1 << b for b in random_.sample(range(64), radius))
            assert any(not change & m for m in masks)


def test_near_duplicates_of_odd_rows(odd):
    prints = [(d if d is not None else -(1 << 63), brute.simhash(t)) for d, t in ODD]
    want = [
        (d, f"{p:016x}", c) for (d, _), (_, p), c in zip(ODD, prints, brute.components(prints), strict=True)
    ]
    assert same(rows_of(simhash.near_duplicates(odd), "doc_id", "fingerprint", "component_id"), want)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2, 7, 2048])
def test_links_reach_all_within_the_radius(spark, block):
    random_ = random.Random(4)
    centres = [random_.getrandbits(64) for _ in range(4)]
    values = {c ^ sum(1 << b for b in random_.sample(range(64), random_.randint(0, 5))) for c in centres for _ in range(40)}
    values |= {random_.getrandbits(64) for _ in range(30)}
    prints = sorted(values)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "print long")
    reached = {r.node: r.root for r in simhash.components(simhash.near_links(frame, 4, block)).collect()}
    got = [reached.get(s, s) for s in signed]
    want = brute.components(list(zip(signed, prints, strict=True)))
    assert got == want


def test_buckets_are_not_broadcast(spark, tmp_path):
    # Spark sizes the buckets like the prints they come from, 31 times too low.
    spark.range(1000).selectExpr("xxhash64(id) AS print").write.parquet(str(tmp_path / "prints"))
    links = simhash.near_links(spark.read.parquet(str(tmp_path / "prints")))
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_duplicates_of_documents(spark):
    docs = documents(spark)
    prints = [(d, brute.simhash(t)) for d, t in docs]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, brute.components(prints), strict=True)]
    got = contract.queries()["op9_simhash"](spark, SF)
    assert same(rows_of(got, "doc_id", "fingerprint", "component_id"), want)


# --- op10


def test_lines_of_odd_rows(odd):
    got = line_dedup.dedup_lines(odd).collect()
    have = [(r.doc_id, r.n_lines, r.n_dropped, brute.sha(r.text or "")) for r in got]
    assert same(have, brute.lines(ODD))
    assert {r.id for r in got} == {"clash"}
    assert line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_lines_by_a_higher_threshold(spark):
    docs = spark.createDataFrame([(i, "a line that is long\nown %d" % i) for i in range(3)], "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.dedup_lines(docs, min_docs=4).collect()} == {0}
    assert sorted(r.n_dropped for r in line_dedup.dedup_lines(docs, min_docs=3).collect()) == [0, 1, 1]
