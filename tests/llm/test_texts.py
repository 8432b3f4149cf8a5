"""Operators that look at one text at a time, against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grantsieve.llm import decontaminate, host_rules, langid, pii, quality, queries, token_files

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(t // 10 + t % 10 for t in twice)) % 10 == 0


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else 0,
                "card": 14 <= len(d) <= 19 and luhn(d),
                "phone": 10 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(out)]


def base_of(text):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in pii.find_spans(text) if s["kind"] in BASE]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab._%+-@0149. ()é", max_size=60))
def test_base_spans_follow_their_patterns(text):
    assert base_of(text) == plain_base(text)


@pytest.mark.parametrize("text", [
    "a@b@c.de", "x@y.z._q@w.v", "4111 1111 1111 1111 5", "4111111111111111, +1 (499) 555-6503%", "1.2.3.4.5.6.7.8",
    "999.1.1.1 1.1.1.1", "0001.2.3.4", "00000000000000", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
])
def test_base_spans_cases(text):
    assert base_of(text) == plain_base(text)


def test_added_spans_need_checksum_or_context():
    found = lambda t: [s["kind"] for s in pii.find_spans(t)]
    assert "iban" in found("pay to GB82 WEST 1234 5698 7654 32 today")
    assert "iban" not in found("pay to GB82 WEST 1234 5698 7654 33 today")
    assert found("call 030 1234 5678 now") == ["local_phone"]
    assert found("part 030 1234 5678 now") == []
    assert found("SSN 123-45-6789") == ["national_id"] and found("item 123-45-6789") == []


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "+" + "1-" * 200_000, "@" * 200_000, "A1" * 200_000):
        pii.find_spans(text)


def test_pii_edges(edge, edge_rows, empty):
    got = {(r["doc_id"], r["base_sha256"], r["spans"]) for r in pii.pii_digest(edge).collect()}
    want = set()
    for d, t, *_ in edge_rows:
        spans = ",".join(plain_base(t or ""))
        want.add((d, hashlib.sha256(spans.encode()).hexdigest(), spans))
    assert got == want and pii.pii_digest(edge).count() == len(edge_rows)
    assert pii.pii_digest(empty).count() == 0


def test_redact(spark):
    df = spark.createDataFrame([("mail me@x.org or 1.2.3.4!",), (None,)], "text string")
    out = df.select(pii.redact(F.col("text"), pii.pii_spans(F.col("text"))).alias("t")).collect()
    assert out[0]["t"] == "mail [email] or [ip]!" and out[1]["t"] is None


def plain_repeats(words, w=8):
    windows = [tuple(words[i : i + w]) for i in range(len(words) - w + 1)]
    hit = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(w)}
    return len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=40))
def test_repeated_words(words):
    assert host_rules.repeated_words(words) == plain_repeats(words)


def test_host_rules_edges(edge, edge_rows, empty):
    rows = host_rules.apply_host_rules(edge).collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        assert not (r["kept"] and r["base_failed"])
    assert {r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert [r["n_dup_lines"] for r in rows if r["doc_id"] == 6] == [0]
    assert host_rules.apply_host_rules(empty).count() == 0


def test_bad_host_takes_its_good_documents(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "too short", "bad") for i in range(40)] + [(100, good, "bad"), (101, good, None)]
    rows += [(200 + i, good, f"h{i % 9}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in host_rules.apply_host_rules(df).collect()}
    assert not kept[100] and kept[101] and all(kept[200 + i] for i in range(90))


def plain_verdicts(rows, max_rate=0.5):
    """Kept by (doc_id, text): failures of each rule by host, moments, shrunk rates, one loop each."""
    def fails(text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, symbols = len(words), sum(text.count(c) for c in "#*$%&|<>")
        repeats = plain_repeats(words) if n < 500 else host_rules.repeated_words([w.encode() for w in words])
        return n < 20 or 100 * repeats > 30 * n, 100 * (len(lines) - len(set(lines))) > 3 * n, 100 * symbols > 10 * n

    failed = [(d, t or "", h, fails(t or "")) for d, t, h in rows]
    bad = set()
    for rule in range(3):
        by_host = {}
        for _, _, h, f in failed:
            if h is not None:
                by_host.setdefault(h, []).append(f[rule])
        big = [x for x in by_host.values() if len(x) > 1]
        a = b = 1.0
        if big:
            total, rates = sum(map(len, big)), [sum(x) / len(x) for x in big]
            mean = (sum(map(sum, big)) + 0.5) / (total + 1)
            spread = max(sum(r * r for r in rates) / len(big) - (sum(rates) / len(big)) ** 2, 0)
            inverse = sum(1 / len(x) for x in big) / len(big)
            between = (spread - mean * (1 - mean) * inverse) / max(1 - inverse, 1e-9)
            strength = min(max(mean * (1 - mean) / between - 1 if between > 0 else total, 1.0), total)
            a, b = mean * strength, (1 - mean) * strength
        bad |= {h for h, x in by_host.items() if (sum(x) + a) / (len(x) + a + b) > max_rate}
    return sorted(((d, t, not f[0] and h not in bad) for d, t, h, f in failed), key=repr), bad


def test_host_verdicts_of_each_rule_against_a_plain_version(spark, edge_rows):
    """Hosts that fail by short texts, repeated lines or symbols go with their good documents; a
    single bad document, a host of a few and documents without a host don't."""
    good = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    lines = lambda i: "\n".join([good(i), *["the same line of words"] * 4])
    rows = [(d, t, h) for d, t, _, h, _ in edge_rows]
    rows += [(1000 + i, good(i), f"h{i % 12}") for i in range(240)] + [(2000 + i, good(i), None) for i in range(5)]
    for k, (host, text) in enumerate(
        (("short", lambda i: f"too short {i}"), ("lines", lines), ("symbols", lambda i: good(i) + " " + "#$ " * 9))
    ):
        rows += [(3000 + 100 * k + i, text(i), host) for i in range(30)] + [(3090 + 100 * k, good(k), host)]
    rows += [(4000, "one bad text", "h1"), (4001, lines(1), "h2"), (4002, lines(2), None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    got = host_rules.apply_host_rules(docs)
    want, bad = plain_verdicts(rows)
    assert {"short", "lines", "symbols"} <= bad and not any(h.startswith("h") for h in bad)
    assert sorted(((r["doc_id"], r["kept"]) for r in got.collect()), key=repr) == sorted(
        ((d, kept) for d, _, kept in want), key=repr
    )


def test_language(spark, edge, edge_rows, empty, small):
    model = langid.fit(spark.createDataFrame(
        [(1, "en", "the dog and the cat"), (2, "de", "der Hund und die Katze"), (3, None, "rien")],
        "doc_id bigint, lang string, text string"))
    assert model.langs == ["de", "en"]
    assert model.predict("The CAT")[0] == "en" and model.predict("Hunde")[0] == "de"
    assert model.predict("12 ³ ½ !") == model.predict(None) == ("und", 0.0)
    assert langid.fit(empty).predict("text") == ("und", 0.0)
    found = edge.select("doc_id", langid.predict(F.col("text"), model).alias("p")).collect()
    assert len(found) == len(edge_rows) and all(0 <= r["p"]["score"] <= 1 for r in found)
    assert {r["p"]["lang"] for r in found if r["doc_id"] in (1, 2, 3, 5)} == {"und"}
    got = queries.QUERIES["op3_langid"](spark, small).join(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    assert got.filter("held_out and lang_pred = lang").count() >= 0.98 * got.filter("held_out").count()


def test_every_unit_of_the_sample_is_known(spark):
    """Many words of one language push no rarer word of another out of the model."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in letters[:4] for b in letters for c in letters for d in letters]
    rows = [(1, "en", " ".join(words * 2)), (2, "es", "queso zorro")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))
    assert set(model.tables[0][0]) == {*words, "queso", "zorro"}
    for n in range(1, 6):
        assert set(model.tables[n][0]) == {g for w in {*words, "queso", "zorro"} for g in langid.grams_of(w, n)}


def test_memo_of_words_may_be_small(spark):
    model = langid.Model(["a", "b"], [({"x": 0}, np.array([[0.0, -1.0]])), ({"y": 0}, np.array([[-1.0, 0.0]]))], 2)
    assert model.predict("x y z q w e r t")[0] in "ab"
    assert model.predict("y yy yyy yyyy yyyyy")[0] == "b"


def test_quality(spark, edge, empty, small):
    one = quality.fit(edge.select("doc_id", quality.text_statistics(F.col("text")).alias("x"), F.lit(1).alias("y")))
    assert one.scores(np.zeros((2, 3))).tolist() == [1.0, 1.0]
    none = quality.fit(empty.select("doc_id", quality.text_statistics(F.col("text")).alias("x"), F.lit(1).alias("y")))
    assert none.scores(np.zeros((1, 3))).tolist() == [0.5]
    got = queries.QUERIES["op6_quality"](spark, small).join(spark.read.parquet(f"{small}/labels.parquet"), "doc_id")
    assert got.filter("held_out and predicted = quality").count() >= 0.9 * got.filter("held_out").count()
    model = quality.Discriminant(np.array([5.0, 5.0]), np.array([[0.0], [2.0]]), np.ones((2, 1, 1)), quality.Shrinkage())
    s = model.scores(np.array([[0.0], [1.0], [2.0]]))
    assert s[0] < 0.5 < s[2] and abs(s[1] - 0.5) < 1e-9


ITEM = "The quick brown fox jumps over the lazy dog, then it sleeps for nine hours."


def test_passages(spark, edge, empty):
    edited = ITEM.replace("quick", "quik").replace("sleeps", "slept").upper()
    docs = spark.createDataFrame(
        [(1, "before " + ITEM + " after"), (2, "x " * 500 + edited + "!!"), (3, "The quick brown fox likes other things."),
         (4, None), (None, ITEM), (5, ITEM.replace(" ", "\n ")), (5, ITEM)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, ITEM, "z"), (8, None, "z"), (9, "shirt", "z"), (None, "", "z")], "item_id bigint, text string, doc_id string")
    found = decontaminate.find_passages(docs, items).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in found) == [(0, 7), (1, 7), (2, 7), (5, 7), (5, 7)]
    by_doc = {r["doc_id"]: r for r in found}
    assert by_doc[1]["edits"] == 0 and (by_doc[1]["start"], by_doc[1]["end"]) == (7, 7 + len(ITEM))
    assert by_doc[2]["edits"] == 3
    assert {r["doc_id"] for r in decontaminate.without_passages(docs, items).collect()} == {3, 4}
    assert decontaminate.find_passages(edge, items).count() == 0
    assert decontaminate.find_passages(docs, items.limit(0)).count() == 0
    assert decontaminate.find_passages(empty, items).count() == 0
    blocks = decontaminate.Budget(block_chars=10)
    assert decontaminate.find_passages(docs, items, blocks).count() == 5


def test_short_items_are_found_unchanged_between_words(spark):
    """Items of 3, 8 and 23 characters: as they are, with other case and white space, inside a
    word, with one sign changed, and at both ends of a text."""
    items = {3: "abc", 8: "abcd 12?", 23: "what is 7 times 8, now?"}
    assert {k: len(v) for k, v in items.items()} == {k: k for k in items}
    docs, want = [], set()
    for m, item in items.items():
        for n, (text, hit) in enumerate([
            (item, True), (f"so {item} it is", True), (f"So\n{item.upper()}\tthen", True), (f"({item})", True),
            (f"x{item}", False), (f"{item[:-1]}x and", False), (f"{item} {item}", True), ("", False), (None, False),
        ]):
            docs.append((100 * m + n, text))
            want |= {(100 * m + n, m)} if hit else set()
    docs.append((7, items[3] + "d " + items[23]))
    want.add((7, 23))
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    found = decontaminate.find_passages(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == sorted(want)
    assert all(r["edits"] == 0 and r["end"] - r["start"] == r["item_id"] for r in found)


def edit_distance_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, len(ITEM) - 1), st.sampled_from(["x", "", "yz"])), max_size=9), st.integers(0, 30))
def test_passages_against_plain_alignment(edits, lead):
    text = list(ITEM.lower())
    for at, new in edits:
        text[at] = new
    text = "q" * lead + " " + "".join(text) + " tail"
    budget = decontaminate.Budget()
    index = decontaminate.Index([(1, ITEM)], budget)
    distance = edit_distance_inside(ITEM.lower(), decontaminate.plain(text))
    found = index.search([decontaminate.plain(text)])[0]
    assert [f["edits"] for f in found] == ([distance] if distance <= budget.edits(len(ITEM)) else [])


def test_token_files(spark, edge, edge_rows, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_files.vocabulary())
    got = sorted(queries.token_table(spark, edge).collect(), key=lambda r: r["start"])
    want = sorted(
        (d is not None, d or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for d, x, *_ in edge_rows for ids in [t.encode(x or "", add_special_tokens=False).ids + [2]]
    )
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == want
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert keys == sorted(keys)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    assert queries.token_table(spark, empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_chunks_encode_as_the_whole_text(text):
    e = token_files.encoder(token_files.vocabulary())
    ids = np.frombuffer(e.encode([text.encode()])[0], e.dtype).tolist()
    assert ids == e.tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_token_ids_of_words_in_one_text_are_those_of_whole_texts():
    from tokenizers import Tokenizer

    rng = random.Random(2)
    signs = ["a", "Bc", "é", "É", "9", ".", ",", "'s", " ", " ", "日", "🙂", "_", ")", "İ", "Σ", "ς", "ʼn", "ﬁ", "ǅ", "²", "\U0001df00", "\n"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    texts += ["<|endoftext|>", "a<|endoftext|>b, <|startoftext|>", "Ab <|ENDOFTEXT|> ABC, dE. <|EndOfText|>x", "end.) ...", "x..., y;:!?", "\U00031350 \U0001df25x abc"]
    path = token_files.vocabulary()
    encoder, t = token_files.Encoder(path), Tokenizer.from_file(path)
    for _ in range(2):
        got = [np.frombuffer(b, encoder.dtype).tolist() for b in encoder.encode([x.encode() for x in texts])]
        assert got == [e.ids + [2] for e in t.encode_batch(texts, add_special_tokens=False)]
