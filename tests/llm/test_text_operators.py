"""Rules, secrets, byte-level BPE, templates and chat formatting on odd rows and against brute force."""

import base64
import math
import os
import random
import re
import subprocess
import sys
import time

import duckdb
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerlake.llm import bpe_duckdb, chat_format, common, quality_cascade, secret_scan, template_decontam

# --- rules


def measured(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {i + j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(5)} if len(w) < 400 else set()
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_by_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        word = lambda: rng.choice(["a", "b|", "é&", "##", "日本", "word"])
        rows.append((i, "".join(word() + rng.choice([" ", "\n", "\t", "  ", "\n\n"]) for _ in range(rng.randrange(60)))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: tuple(r[c] for c in quality_cascade.COUNTS) for r in quality_cascade.cascade(df, counts=quality_cascade.COUNTS).collect()}
    assert found == {i: measured(t) for i, t in rows}


def test_order_does_not_change_the_verdict(spark, odd_docs, no_docs):
    names = [r.name for r in quality_cascade.RULES]
    verdicts = [
        sorted((r["doc_id"] or 0, r["kept"]) for r in quality_cascade.cascade(odd_docs, order=order).collect()) for order in (names, names[::-1], None)
    ]
    assert verdicts[0] == verdicts[1] == verdicts[2]
    by = dict(verdicts[0])
    assert by[1] and by[0] and not by[4] and not by[5] and not by[6] and not by[8]
    kept = quality_cascade.kept_rows(odd_docs)
    assert kept.columns == odd_docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, None}
    assert quality_cascade.cascade(no_docs).collect() == [] and quality_cascade.kept_rows(no_docs).collect() == []
    profile = {r["rule"]: r for r in quality_cascade.rule_profile(odd_docs).collect()}
    assert set(profile) == set(names) and profile["few_words"]["rejected"] == 6


# --- secrets

FORMS = st.lists(
    st.sampled_from(["password", "API_KEY", "apikey", "token", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef", "zz", "\n", "é", "secret", "K"]),
    max_size=14,
).map("".join)


@settings(max_examples=300, deadline=None)
@given(FORMS)
def test_base_spans_by_plain_patterns(text):
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    plain = [("assign", m.start(), m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    plain += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    plain += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    assert secret_scan.base_spans(text) == plain


def test_guess_cost():
    cost = secret_scan.guess_cost
    for weak in ("password", "P@ssw0rd", "qwertyuiop", "aaaaaaaaaaaa", "abcabcabcabc", "2019-04-05", "drowssap", "changeme2020", "abcdefgh"):
        assert cost(weak) < 8, weak
    for strong in ("gT4#kq91z", "7602ad27cf5550de1c", "Zx9kQ2mvTT", "correct-Xq-battery-97-Vp"):
        assert cost(strong) > secret_scan.MIN_COST, strong
    assert cost("ab" * 5000) < 10 < cost("".join(random.Random(1).choices("abcdefghij0123456789", k=3000)))


@pytest.mark.parametrize("text, value", [
    ("my pwd is gT4#kq91zLp, ok", "gT4#kq91zLp"), ("Authorization: Bearer aB3.xYz91-QQ_r7", "aB3.xYz91-QQ_r7"),
    ("db://bob:Zx9kQ2mvTT@host/x", "Zx9kQ2mvTT"), ("password = changeme", None), ("the token ring and key words", None), ("passage: extraordinary", None),
])
def test_guessed_spans(text, value):
    assert [text[a:b] for _, a, b, _ in secret_scan.guessed_spans(text)] == ([value] if value else [])


@pytest.mark.parametrize("text, value", [
    ("DB_PASSWORD=gT4#kq91zLp", "gT4#kq91zLp"), ("auth_token: gT4#kq91zLp", "gT4#kq91zLp"), ("aws_secret_access_key = wJalrXUtnFEMIK7MDENG", "wJalrXUtnFEMIK7MDENG"),
    ("clientSecret: 'gT4#kq91zLp'", "gT4#kq91zLp"), ("dbPass=gT4#kq91zLp", "gT4#kq91zLp"), ("note: see: x_pwd: gT4#kq91zLp", "gT4#kq91zLp"), ("the secret is gT4#kq91zLp.", "gT4#kq91zLp"),
    ("the secret is patience", None), ("my password is rhinoceros!", None), ("the compass: gT4#kq91zLp", None), ("the author: gT4#kq91zLp", None), ("key: gT4#kq91zLp", None),
])
def test_names_and_prose(text, value):
    assert [text[a:b] for _, a, b, _ in secret_scan.guessed_spans(text)] == ([value] if value else [])


def test_words_of_the_corpus_are_cheap(spark):
    rows = [(i, "grumblewick parsnipper said nothing of it") for i in range(9)] + [(10, "token: grumblewickparsnipper"), (11, "token: grumblewickqqzzvxkk")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    ranks = secret_scan.common_words(docs)
    assert ranks["grumblewick"] < 200 and "qqzzvxkk" not in ranks
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in secret_scan.scan(docs).collect()}
    assert kinds[10] == ["assign"] and kinds[11] == ["assign", "guess"]


def cheapest(value):
    """The least cost over all segmentations, tried one by one."""
    lower = value.lower()
    plain, per_char, switch = lower.translate(secret_scan.LEET), math.log10(max(10, secret_scan._class_size(value))), math.log10(2)
    edges = {}
    for end in range(1, len(value) + 1):
        edges[end] = [(start, cost) for start, cost, _ in secret_scan._segments(value, lower, plain, end, secret_scan.RANK)]
        for unit in range(1, 9):
            times = 1
            while end - (times + 1) * unit >= 0 and value[end - (times + 1) * unit : end - times * unit] == value[end - unit : end]:
                times += 1
            if times > 1:
                edges[end].append((end - (times - 1) * unit, math.log10(times)))

    def cuts(end, brute):
        """Costs of all cuts of value[:end]; ``brute``: brute force comes next."""
        if not end:
            yield 0.0
            return
        for cost in cuts(end - 1, True):
            yield cost + per_char + (0 if brute else switch)
        for start, cost in edges[end]:
            for before in cuts(start, False):
                yield before + cost + switch

    return min(cuts(len(value), False))


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="abc1Pqwe", max_size=8) | st.lists(st.sampled_from(["pass", "Key", "2019", "qwe", "aa", "x", "drow", "1"]), max_size=3).map("".join))
def test_the_least_cost_of_all_segmentations(value):
    assert math.isclose(secret_scan.guess_cost(value), cheapest(value), abs_tol=1e-9)


def test_long_texts_are_scanned_in_proportion():
    for text in ("token" * 40_000, "a-" * 100_000 + ": x", "secret = " * 30_000, "://" + "u" * 200_000, "Bearer " * 30_000, "pass:" * 40_000):
        start = time.time()
        secret_scan.secret_spans(text)
        assert time.time() - start < 20


def test_scan_and_redaction(spark, odd_docs, no_docs):
    text = "a password=hunter22 b é token: \"1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae\" c"
    docs = odd_docs.unionByName(spark.createDataFrame([(50, text, "en", "s", len(text), "k", 1.0, True)], odd_docs.schema))
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.scan(docs).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in spans[50]] == [("assign", 2, 19), ("assign", 24, 72), ("hex", 32, 72), ("guess", 32, 72)]
    assert spans[5] == spans[4] == [] and len(spans) == 11
    after = {r["doc_id"]: r for r in secret_scan.redacted(docs).collect()}
    assert after[50]["text"] == 'a [SECRET] b é [SECRET]" c' and after[50]["n_chars"] == len(after[50]["text"])
    assert after[5]["text"] is None and after[8]["n_chars"] == len(after[8]["text"])
    assert secret_scan.redacted(docs).columns == docs.columns and secret_scan.redacted(docs).count() == docs.count()
    assert secret_scan.scan(no_docs).collect() == secret_scan.redacted(no_docs).collect() == []


# --- byte-level BPE


@pytest.fixture(scope="module")
def coder():
    return bpe_duckdb.tokenizer(bpe_duckdb.default_path(), bpe_duckdb.default_pattern())


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=bpe_duckdb.default_pattern(), mergeable_ranks=coder.ranks, special_tokens={})


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(max_size=120), max_size=5))
def test_like_the_library(coder, library, texts):
    ids = coder.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert coder.decode(ids) == [t.encode() for t in texts]


def test_long_pieces(coder, library):
    rng = random.Random(6)
    texts = ["a" * 5000, "ab" * 700 + "abc" * 300, "".join(rng.choices("abcdefgh", k=4000)), "é" * 999, "=" * 1500, "<|endoftext|>"]
    assert [x.tolist() for x in coder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_a_vocabulary_that_is_not_in_merge_order(tmp_path):
    """Ranks in any order: long pieces are contracted pair by pair, as the library does."""
    rng = random.Random(3)
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"abc", b"bc", b"aa", b"aaa", b"ca", b"abca", b"caab"]
    ranks = list(range(256)) + rng.sample(range(256, 300), len(tokens) - 256)
    ranks[tokens.index(b"abca")], ranks[tokens.index(b"ab")] = 256, 299
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in zip(tokens, ranks)))
    own = bpe_duckdb.Tokenizer(str(path), r"\S+|\s+")
    assert not own.ordered
    texts = ["".join(rng.choices("abc", k=k)) for k in (5, 60, 70, 200)] + ["aaaa" * 30]
    expected = tiktoken.Encoding("x", pat_str=r"\S+|\s+", mergeable_ranks=dict(zip(tokens, ranks)), special_tokens={})
    assert [x.tolist() for x in own.encode(texts)] == [expected.encode_ordinary(t) for t in texts]


def test_what_is_remembered_is_forgotten(coder, library, monkeypatch):
    monkeypatch.setattr(bpe_duckdb, "CACHE", 3)
    for texts in (["alpha beta gamma delta", "", "alpha beta gamma delta"], ["alpha xyzzyq"], [], ["é beta"]):
        ids = coder.encode(texts)
        assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
        assert coder.decode(ids) == [t.encode() for t in texts]


CODING = """
import random, re
from tickerlake.llm import bpe_duckdb
from tickerlake.llm.common import give_back

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

coder, rng = bpe_duckdb.tokenizer(bpe_duckdb.default_path(), bpe_duckdb.default_pattern(), sparing=True), random.Random(8)
words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 12))) for _ in range(60_000)]
coder._pieces(words[:500])
give_back()
before = held()
coder._pieces(words)
give_back()
print("MB", held() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory cannot be read here")
def test_a_worker_gives_the_memory_of_contractions_back():
    """An executor's Python workers share its memory with the JVM; a database that is not sparing keeps some 30 MB in each."""
    env = os.environ | {"PYTHONPATH": os.pathsep.join([common.ROOT, os.environ.get("PYTHONPATH", "")])}
    run = subprocess.run([sys.executable, "-c", CODING], env=env, capture_output=True, text=True, timeout=300)
    assert not run.returncode, run.stderr
    assert float(run.stdout.split("MB")[1]) < 18


def test_tokens_encode_to_themselves(coder):
    """What the contraction of all leftmost pairs at once rests on."""
    tokens = [t for t in coder.ranks if 1 < len(t)]
    got = coder._contract(tokens)
    assert [int.from_bytes(g, "little") if len(g) == 4 else None for g in got] == [coder.ranks[t] for t in tokens]


def test_coding_of_odd_rows(spark, odd_docs, no_docs, library):
    rows = bpe_duckdb.encode_decode(odd_docs).collect()
    given_rows = {r["doc_id"]: r["text"] or "" for r in odd_docs.collect()}
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert bytes(r["decoded"]).decode() == given_rows[r["doc_id"]]
        assert list(r["ids"]) == library.encode_ordinary(given_rows[r["doc_id"]])
    assert bpe_duckdb.encode_decode(no_docs).collect() == []


@pytest.mark.parametrize("before", ["token: Bearer ", '"auth": "Bearer ', "auth = Basic ", "https://" + "u" * 70 + ":"])
def test_the_value_after_a_scheme_is_the_secret(before):
    text = before + "aB3.xYz91-QQ_r7" + ("@host" if "://" in before else " end")
    assert "xYz91" not in secret_scan.redact(text, secret_scan.secret_spans(text))


# --- templates

ITEM = "Yesterday afternoon Anna Smith bought 12 apples, then Anna Smith paid 12 dollars and 3.5 kg of flour for Bob at the old market near the river."


def test_templates(spark, odd_docs, no_docs):
    swapped = ITEM.replace("Anna Smith", "Clara Jones").replace("12", "77").replace("3.5 kg", "900 g").replace("Bob", "Eve")
    torn = ITEM.replace("Anna Smith paid", "Dora Miller paid").replace("12 dollars", "99 dollars")
    docs = odd_docs.select("doc_id", "text", "key").unionByName(
        spark.createDataFrame([(20, f"Intro words. {ITEM} More."), (21, swapped), (22, torn), (23, ITEM[:60]), (24, "the only short item"), (24, "the only short item"), (25, ITEM)], "doc_id bigint, text string").selectExpr("*", "'x' AS key")
    )
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (None, ITEM), (4, "only short item"), (5, "two words")], "item_id bigint, text string").selectExpr("*", "1 AS tokens", "2 AS size")
    found = {(r["doc_id"], r["item_id"]): r for r in template_decontam.contaminated(docs, items).collect()}
    assert {k for k in found if k[1] == 1} == {(20, 1), (21, 1), (22, 1), (25, 1)} and (24, 4) in found
    assert not [k for k in found if k[1] not in (1, 4)]
    assert found[20, 1]["same_values"] and not found[21, 1]["same_values"]
    assert found[25, 1]["n_windows"] == found[25, 1]["n_item_windows"] == found[21, 1]["n_windows"]
    # Windows that hold both places of one name or number, filled differently, do not count.
    assert found[22, 1]["n_windows"] < found[21, 1]["n_windows"]
    clean = template_decontam.decontaminated(docs, items)
    assert clean.columns == docs.columns and not {20, 21, 22, 24, 25} & {r["doc_id"] for r in clean.collect()}
    assert template_decontam.contaminated(no_docs, items).collect() == template_decontam.contaminated(docs, items.where("false")).collect() == []
    assert template_decontam.decontaminated(docs, items.where("false")).count() == docs.count()


def test_rows_without_an_id_are_decontaminated(spark):
    docs = spark.createDataFrame([(None, f"Intro words. {ITEM} More."), (None, "some other text"), (1, ITEM), (None, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert {r["text"] for r in template_decontam.decontaminated(docs, items).collect()} == {"some other text", None}


def test_verbatim_copies_that_templates_miss(spark):
    """Numbers only, one token, a script without spaces, a first word or a line break that changes what is a name."""
    items = ["Compute 12 * 34 + 56 - 78 / 9", "Antidisestablishmentarianism?", "日本の首都はどこですか", "What is the capital of France", "they asked old Anna Smith for some bread"]
    texts = [f"before it {t} after it" for t in items]
    texts[2] = "前の文章" + items[2] + "次の文章"
    texts[4] = "so they asked old\nAnna  Smith for some bread again"
    docs = spark.createDataFrame([*enumerate(texts), (9, "nothing of these, 12 and 34")], "doc_id bigint, text string")
    pairs = template_decontam.contaminated(docs, spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string"))
    assert sorted((r["doc_id"], r["item_id"], r["same_values"]) for r in pairs.collect()) == [(i, i, True) for i in range(5)]


def test_the_sql_finds_what_templates_miss(spark):
    """The whole SQL, its plain branch too, on rows of every kind."""
    items = ["Compute 12 * 34 + 56 - 78 / 9", "Antidisestablishmentarianism?", "日本の首都はどこですか", "What is the capital of France", "they asked old Anna Smith for some bread", ITEM, "Why?", ""]
    texts = [f"before it {t} after it" for t in items] + ["前の文章" + items[2] + "次の文章", "they asked old\nAnna  Smith for some bread again", ITEM.replace("12", "9"), "why why why", None]
    docs, bench = list(enumerate(texts)), list(enumerate(items))
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", bench)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    found = template_decontam.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string"))
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(template_decontam.OP4_SQL).fetchall())


def test_runs_that_would_overflow_a_recursive_pattern(spark):
    long = ["so " + "Anna " * 100_000, "1." * 100_000 + "1", "x " + "Ab " * 3000 + ITEM + " 1:2:3" * 20_000]
    pairs = template_decontam.contaminated(spark.createDataFrame(list(enumerate(long)), "doc_id bigint, text string"), spark.createDataFrame([(1, ITEM), (2, "one two three four five " * 200)], "item_id bigint, text string"))
    assert [(r["doc_id"], r["item_id"]) for r in pairs.collect()] == [(2, 1)]


def test_repeated_windows_grow_with_the_text(spark):
    """A text and an item that repeat one window meet once per different window."""
    docs = spark.createDataFrame([(1, "la " * 20_000), (2, "la la la")], "doc_id bigint, text string")
    [pair] = template_decontam.contaminated(docs, spark.createDataFrame([(1, "la " * 500)], "item_id bigint, text string")).collect()
    assert (pair["doc_id"], pair["n_windows"], pair["n_item_windows"]) == (1, 493, 493)


def test_an_item_that_says_nothing_takes_nothing_away(spark):
    docs = spark.createDataFrame([(i, f"nobody knows why number {i} came") for i in range(20)] + [(20, "Why not try something else entirely then?")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "Why?"), (2, "I am a"), (3, None), (4, "why not try something else")], "item_id bigint, text string")
    assert {r["doc_id"] for r in template_decontam.decontaminated(docs, items).collect()} == set(range(20))
    assert {r["item_id"] for r in template_decontam.undecidable(items).collect()} == {1, 2, 3}


# --- chat

TEXTS = ["hi", "", None, "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "back\\slash <\\| [\\INST]", "<<SYS>>x<</SYS>>", "many words " * 40, "日本 \U0001f642"]


def test_windows_read_back(spark):
    rng = random.Random(8)
    rows = []
    for conv in list(range(30)) + [None]:
        for turn in range(rng.choice([1, 2, 5, 40])):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "tool\n<x", None])
            rows.append((conv, turn if rng.random() < 0.97 else None, role, rng.choice(TEXTS)))
    rows += rows[:3]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS window", "'n' AS n").repartition(3)
    windows = chat_format.format_windows(df, budget=120, history_tokens=30, history_turns=2)
    back = {r["conv_id"]: r for r in chat_format.read_back(windows).collect()}
    turns = {}
    for conv, turn, role, text in rows:
        turns.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    assert set(back) == set(turns)
    for conv, own in turns.items():
        own.sort()
        assert back[conv]["turns"] == "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        assert back[conv]["n_turns"] == len(own)
        assert back[conv]["loss_text"] == "".join(t for _, _, r, t in own if r == "assistant")
    for w in windows.collect():
        body = [p for p in w["text"].split(chat_format.CLOSE) if p]
        own = [len(p.split("\n", 1)[1].split()) for p in body[w["n_context"] :]]
        assert len(own) == 1 or sum(own) <= 120
        assert w["text"].count(chat_format.OPEN) == len(body)
    assert chat_format.read_back(chat_format.format_windows(df.where("false"))).collect() == []
