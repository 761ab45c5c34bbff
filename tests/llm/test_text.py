"""Edge cases and brute-force comparisons of the text operators."""

import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.llm import langid, neardup, packing, quality, secrets_scan, spencode, tokencount, tokenfile
from wakeline.llm.textkernel import repeated_words, shingle_set, word_bounds
from wakeline.llm.tokenizers_io import public_path

LONG = "of the ing tion. " * 6000
TEXTS = [None, "", " ", "one", "a b c d", "the same words again " * 30, "Word word WORD wörd 日本\n\n x", LONG,
         "tabs\tand\x0bfeeds  double   blanks ", "▁ ▁▁ <|endoftext|> </s>", "the same words again " * 30, "a" * 3000]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t or ""), "x", "y") for i, t in enumerate(TEXTS)]
    rows += [(None, "a text without an id, ten words long or a bit more", None, None, None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


def _empty(docs):
    return docs.limit(0)


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_words_and_repeats_match_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        t = "".join(rnd.choice(["a", "b", "ab", "B", " ", "\n", "\t", "é", " ", "  "]) for _ in range(rnd.randint(0, 60)))
        data = t.encode()
        starts, ends = word_bounds(data)
        words = [data[s:e].decode() for s, e in zip(starts, ends)]
        assert words == _words(t)
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert repeated_words(data, starts, ends) == len(covered)
        low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
        want = {tuple(low[i:i + 5]) for i in range(len(low) - 4)} or ({tuple(low)} if low else set())
        assert len(shingle_set(data)) == len(want)


def test_quality_measures_and_edges(docs):
    rows = quality.judged(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        t = r.text or ""
        w = _words(t)
        lines = [x for x in t.split("\n") if _words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert r.n_dup_lines == sum(x in lines[:i] for i, x in enumerate(lines))
        assert r.base_failed == (len(w) < 10 or 100 * r.n_repeat_words > 20 * len(w))
        assert not (r.base_failed and r.kept)
    assert quality.judged(_empty(docs)).count() == 0


def test_quality_fences_follow_the_group(spark):
    """A source full of symbols keeps its ordinary documents; the same document is an outlier elsewhere."""
    def text(i, symbols):
        rnd = random.Random(i)
        return " ".join(f"w{rnd.randint(0, 10**6)}" + "|" * (symbols and k % 2) for k in range(60))
    rows = [(i, text(i, False), "en", "plain") for i in range(300)] + [(1000 + i, text(i, True), "en", "tables") for i in range(300)]
    rows.append((5000, text(7, True), "en", "plain"))
    out = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(v for k, v in out.items() if k != 5000) and not out[5000]


def test_quality_is_the_same_with_shuffled_fences(docs, monkeypatch):
    cols = ["doc_id", "text", "base_failed", "kept"]
    want = sorted(map(str, quality.judged(docs).select(*cols).collect()))
    monkeypatch.setattr(quality, "BROADCAST_BYTES", 0)
    assert sorted(map(str, quality.judged(docs).select(*cols).collect())) == want


def test_secret_scan_matches_the_base_patterns(docs, spark):
    rnd = random.Random(1)
    parts = ["password", "Token", "api_key", "apiKEY", '"', "'", ":", " = ", "=", "abcdefgh", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef",
             " ", "\n", "x", "é", "0f" * 16, "secret"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(400)] + TEXTS
    kinds = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
             ("access", r"AKIA[A-Z0-9]+"), ("hex", r"[0-9a-f]+")]
    for t in texts:
        found = []
        for k, (name, p) in enumerate(kinds):
            for m in re.finditer(p, t or ""):
                n = len(m[2]) if k == 0 else m.end() - m.start()
                if n >= (8, 16, 32)[k]:
                    found.append((m.start(), k, m.end(), name))
        joined = ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(found))
        got = secrets_scan.scan_text(t)
        assert got[3] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(got[4].split(","))
    assert secrets_scan.scanned(docs, redact_to="clean").count() == docs.count()
    assert secrets_scan.scanned(_empty(docs)).count() == 0


def test_secret_names_reach_propagated_constants():
    text = 'base = "Kx9-kk21!pq"\nmiddle = base\ndb_password = middle\ncolour = "Kx9-kk21!pr"\n'
    spans = secrets_scan.scan_text(text)[4].split(",")
    at = text.index("Kx9")
    assert f"constant:{at}:{at + 11}" in spans
    assert not any(s.split(":")[1] == str(text.rindex("Kx9")) for s in spans)
    clean = secrets_scan.redact_text(text)
    assert "Kx9-kk21!pq" not in clean and "Kx9-kk21!pr" in clean


def test_piece_encoding_equals_the_library(docs):
    import sentencepiece

    path = public_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in spencode.encoded(docs, path, prefix="p_").collect():
        ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.p_ids == ids and r.p_decoded == sp.decode(ids)
        assert r.p_ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    c = spencode.PieceCodec(open(path, "rb").read())
    rnd = random.Random(2)
    parts = ["a", "th", "e", " ", "  ", "\n", "▁", "é", "é", "日", "\U0001f600", "\x00", "ing", ".", ",", "‍"]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20)))
        assert c.encode(t).tolist() == sp.encode(t, add_bos=True, add_eos=True)
    for _ in range(2000):
        ids = [rnd.choice([0, 1, 2, rnd.randint(3, 258), rnd.randint(259, 31999)]) for _ in range(rnd.randint(0, 6))]
        assert c.decode(np.array(ids, dtype="<u4")) == sp.decode(ids)
    assert spencode.encoded(_empty(docs), path).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(200, 3), (200, 24), (32768, 256)])
def test_token_counts_equal_the_library(docs, chunk, overlap):
    """Short chunks make many splices; a three-character overlap makes some fail, so they are widened."""
    import sentencepiece

    path = public_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    small = docs.withColumn("key", F.monotonically_increasing_id())
    texts = {r.key: r.text or "" for r in small.collect()}
    got = tokencount.token_counts(small, path, chunk_chars=chunk, overlap_chars=overlap).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.key].encode()), len(sp.encode(texts[r.key])))
        assert r.over_limit == (r.n_tokens > 4096)
    assert tokencount.token_counts(_empty(docs), path).count() == 0


def test_token_counts_of_literal_blank_marks_equal_the_library(spark):
    import sentencepiece

    path = public_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rnd = random.Random(12)
    texts = ["▁▁▁" + "ab " * 5000, "one ▁▁ " + "the same " * 3000 + "▁" * 9 + " of" * 4000, "▁▂▃ load the ▁ page ▁▁ again " * 400, "▁a" * 6000, "x ▁" * 5000, "▁" * 9000, " ▁" * 5000 + "end",
             "".join(rnd.choice(["▁", "▁▁▁", " ", "a", "the ", "日本", "▃▅", "one two "]) for _ in range(6000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "key int, text string")
    for chunk, overlap in ((1000, 64), (3000, 256)):
        for r in tokencount.token_counts(docs, path, chunk_chars=chunk, overlap_chars=overlap).collect():
            assert (r.n_bytes, r.n_tokens) == (len(texts[r.key].encode()), len(sp.encode(texts[r.key])))


def test_elias_fano_round_trip():
    rnd = random.Random(4)
    for n, top in [(0, 1), (1, 0), (1, 2**40), (700, 10), (1000, 10**6), (513, 2**62)]:
        values = sorted(rnd.randint(0, top) for _ in range(n))
        ef = tokenfile.EliasFano.from_bytes(memoryview(tokenfile.EliasFano.of(np.array(values, dtype=np.uint64)).to_bytes()))
        assert ef.values().tolist() == values
        assert [ef.select(i) for i in range(n)] == values


@pytest.mark.parametrize("shard_docs", [3, 10_000])
def test_token_files_round_trip(docs, scratch, spark, shard_docs):
    from tokenizers import Tokenizer

    path = public_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    folder = f"file://{scratch}/{shard_docs}"
    tokenfile.write_tokens(docs, folder, path, shard_docs=shard_docs)
    got = sorted(tokenfile.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(tok.encode(r.text or "", add_special_tokens=False).ids + [0])
    keys = [r.doc_id for r in got]
    assert keys == sorted(keys, key=lambda d: -1 if d is None else d) and len(got) == docs.count()
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and list(r.ids) in want[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
        at += r.n_tokens
    tokenfile.write_tokens(_empty(docs), folder + "-empty", path)
    assert tokenfile.read_tokens(spark, folder + "-empty").count() == 0


def test_language_tasks_get_texts_in_small_batches(spark, docs):
    import pyarrow as pa

    from wakeline.session import BATCH_BYTES, small_batches

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    long = spark.range(0, 6000, 1, 1).select(F.expr("repeat('word ', 400)").alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    spark.conf.unset(key)
    try:
        langid.identified(docs, langid.fit_open(docs))
        assert max(r.n for r in long.mapInArrow(sizes, "n long").collect()) < 1.5 * BATCH_BYTES
        spark.conf.set(key, "123456")
        small_batches(spark)
        assert spark.conf.get(key) == "123456"
    finally:
        spark.conf.unset(key)


def test_token_encoder_equals_the_library_and_asks_it_for_few_units():
    import pyarrow as pa

    from wakeline.llm.tokenizers_io import json_tokenizer

    with open(public_path("byte_bpe_50k.json"), "rb") as fh:
        tokenizer = json_tokenizer(fh.read())
    asked = []

    class Counted:
        def __getattr__(self, name):
            return getattr(tokenizer, name)

        def encode_batch_fast(self, units, **kw):
            asked.extend(units)
            return tokenizer.encode_batch_fast(units, **kw)

    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "\t", "\xa0", "\x0b", "\x1c", "\x85", "\u3000", "é", "日", "1", "'s", "!", "<|endoftext|>",
             "don't", " the", " word,", " wörd.", "ſtŁ", "×", "ª", "\nAnd", ".\n", "(", "...)", " it'll!", "|>", "<|", "`"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(5000)] + [None, "", " ", "  ", "\n"]
    encoder = tokenfile.WordEncoder(Counted(), 2)
    got = [x for s in range(0, len(texts), 999) for x in encoder.encode(pa.array(texts[s:s + 999], pa.string()), b"\0\0").to_pylist()]
    want = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u2").tobytes() for t in texts]
    assert got == want
    assert encoder.encode(pa.array([], pa.string()), b"\0\0").to_pylist() == []
    asked.clear()
    encoder.encode(pa.array(["Plain words, with màrks.\nAnd (a) line; no 7"], pa.string()))
    assert asked == [" (a)", " 7"]


def test_language_id(docs, spark):
    rnd = random.Random(9)
    vocab = {"aa": ["kala", "mato", "suli", "vene"], "bb": ["gruk", "drosh", "blim", "krent"]}
    rows = [(i, " ".join(rnd.choice(vocab[l]) for _ in range(30)), l) for i, l in enumerate(["aa", "bb"] * 60)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_open(train)
    got = {r.doc_id: r for r in langid.identified(docs, model).collect()}
    assert got[0].lang_pred == got[1].lang_pred == "und" and got[0].score == 0.0
    assert all(0.0 <= r.score <= 1.0 for r in got.values())
    assert model.predict("kalamato venesuli")[0] == "aa" and model.predict("grukdrosh krentblim")[0] == "bb"
    assert model.predict("日本")[0] == "aa"
    pred = langid.identified(train, model).collect()
    assert all(r.lang == r.lang_pred for r in pred)
    odd = spark.createDataFrame([(1, "½ ² ③ 12 !"), (2, "½ a")], "doc_id long, text string")
    assert [r.lang_pred == "und" for r in langid.identified(odd, model).orderBy("doc_id").collect()] == [True, False]
    nothing = langid.fit_open(_empty(docs))
    assert {r.lang_pred for r in langid.identified(docs, nothing).collect()} == {"und"}


def _literals(text):
    return {text[s:e] for s, _, e in secrets_scan.lexed_spans(text)}


def test_typed_and_chained_bindings_keep_their_literals():
    secret = "Kx9-kk21!pq"
    for form in ('db_password: str = "{}"', "apiKey: string | undefined = '{}'", 'let token: &str = "{}";', 'token: String? = "{}"',
                 'token: Optional[Dict[str, int]] = "{}"', 'def f(password: str="{}", title: str="Other-1234x")',
                 'password = pw = "{}"', '$password = $pw = "{}"', 'password=pw="{}"', 'a = b = password = "{}"',
                 'password = cfg["pw"] = "{}"', 'ERROR: db_pwd: {}', 'env: a=pwd={}'):
        text = form.format(secret)
        assert _literals(text) == {secret}, text
        assert secret not in secrets_scan.redact_text(text)
    for text in (f'title: str = "{secret}"', f'password: str\ntitle: str = "{secret}"', f'if password == other == "{secret}"'):
        assert not _literals(text), text
    assert _literals("token=QWxhZGRpbjpvcGVuQ2x=") == {"QWxhZGRpbjpvcGVuQ2x="}
    assert _literals("my_token: abcd1234efgh: expired") == {"abcd1234efgh"}


def test_all_kinds_of_quotes_are_read_and_calls_are_left():
    secret = "Kx9-kk21!pq"
    for form in ('db_pwd = b"{}"', "db_pwd = r'{}'", 'db_pwd = f"{}"', 'db_pwd = rb"{}"', 'db_pwd = """{}"""', "db_pwd = `{}`",
                 'const my_pwd = `{}`;', 'my_pwd: str = u"{}"'):
        text = form.format(secret)
        assert _literals(text) == {secret}, text
        assert secret not in secrets_scan.redact_text(text), text
    for text in ('api_key = os.environ.get("K")', 'my_pwd = base64.b64decode(x)', 'db_token = self.make_Token2(1)',
                 'my_secret = hashlib.sha256(x)', 'token: getTokenFrom9(y)'):
        assert not _literals(text) and secrets_scan.redact_text(text) == text, text
    assert _literals('db_pwd = "" + "Kx9-kk21!pq"') == {secret}


def test_long_padded_and_unhinted_literals_are_found():
    rnd = random.Random(8)
    chars = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)]))
    blob = "".join(rnd.choice(chars) for _ in range(6000))
    short = "q7Zt0mXv91LbKc83RhYp"
    key = "-----BEGIN PRIVATE KEY-----\\n" + "\\n".join(blob[i:i + 64] for i in range(0, 6000, 64)) + "\\n-----END PRIVATE KEY-----"
    for form, value in (('client_secret_blob = "{}"', blob), ("client_secret_blob: '{}'", blob), ("<client_token>{}</client_token>", blob),
                        ('private_key = "{}"', key), ('db_pwd = "{}"', "A" * 300 + blob[:200]), ('db_pwd = "{}"', blob[:300] + "A" * 9000),
                        ('my_api = "{}"', short), ('to_ken = "{}"', short)):
        assert value in _literals(form.format(value)), form
        assert value not in secrets_scan.redact_text(form.format(value))
    assert not _literals('db_pwd = "' + "A" * 6000 + '"')
    assert not _literals('db_pwd = "' + "a word and one more " * 400 + '"')


def test_language_of_copies_keeps_its_sample(spark):
    rnd = random.Random(4)
    word = lambda syllables: "".join(rnd.choice(syllables) for _ in range(3))
    rare = [" ".join(word(["ka", "lo", "mi", "ve"]) for _ in range(12)) for _ in range(200)]
    rows = [(t, "aa") for t in rare] + [(rare[0], "aa")] * 20_000 + [(None, "aa")] * 50 + [(None, "cc")] * 5
    rows += [(" ".join(word(["gru", "dro", "bli"]) for _ in range(12)), "bb") for _ in range(400)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    limits = langid.FitLimits(docs_per_lang=40)
    got = {r["lang"]: r["count"] for r in langid.sample_rows(docs, "text", "lang", limits).groupBy("lang").count().collect()}
    assert set(got) == {"aa", "bb"} and all(20 <= n <= 60 for n in got.values())
    model = langid.fit(docs, limits=limits)
    assert {model.predict(t)[0] for t in rare} == {"aa"}


def _brute_language(rows, text):
    """Language by the rule's definition, in plain dictionaries."""
    counts = {}
    for body, lang in rows:
        for w in re.findall(r"[^\W\d_]+", body.lower()):
            for k, item in [(0, w)] + [(n, f"<{w}>"[i:i + n]) for n in range(1, 6) for i in range(len(w) + 3 - n)]:
                key = counts.setdefault(lang, {}).setdefault(k, {})
                key[item] = key.get(item, 0) + 1
    langs = sorted(counts)
    known = [{i for l in langs for i, c in counts[l].get(k, {}).items() if k or c > 1} for k in range(6)]
    size = {(l, k): sum(counts[l].get(k, {}).values()) + 0.5 * (len(known[k]) + 1) for l in langs for k in range(6)}
    score = dict.fromkeys(langs, 0.0)
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        items, rest = [(0, w)], f"<{w}>"
        if w not in known[0]:
            items = []
            while rest:
                n = next((n for n in range(min(5, len(rest)), 0, -1) if rest[:n] in known[n]), 0)
                items += [(n, rest[:n])] if n else []
                rest = rest[n or 1:]
        for l in langs:
            for k, i in items:
                c = counts[l].get(k, {}).get(i, 0)
                score[l] += math.log((c if k or c > 1 else 0) + 0.5) - math.log(size[l, k])
    best = min(langs, key=lambda l: (-score[l], l))
    return best, 1 / sum(math.exp(max(score[l] - score[best], -700)) for l in langs)


def _invented(rnd, langs, texts, words):
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocab = [["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8))) for _ in range(words)] for _ in range(langs)]
    return [(" ".join(rnd.choice(vocab[l]) for _ in range(20)), f"l{l:03}") for l in range(langs) for _ in range(texts)]


def test_language_scores_match_brute_force(spark):
    rnd = random.Random(21)
    rows = _invented(rnd, 4, 12, 25)
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [t for t, _ in rows] + [t[3:90] for t, _ in rows]
    texts += ["".join(rnd.choice(letters + "  ") for _ in range(rnd.randint(1, 60))) + "a" for _ in range(100)]
    for t in texts:
        (lang, score), (want, sure) = model.predict(t), _brute_language(rows, t)
        assert math.isclose(score, sure, rel_tol=1e-4, abs_tol=1e-9) and (lang == want or sure < 0.51)


def test_texts_that_no_language_explains_go(spark):
    rnd = random.Random(22)
    rows = _invented(rnd, 3, 60, 80)
    # A few labels are wrong.
    rows = [(t, "l000" if i % 40 == 39 else l) for i, (t, l) in enumerate(rows)]
    model = langid.fit_fences(langid.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3)))
    letters = "abcdefghijklmnopqrstuvwxyz"
    noise = [" ".join("".join(rnd.choice(letters) for _ in range(6)) for _ in range(20)) for _ in range(50)]
    mixed = [" ".join(rows[i][0].split()[:10] + rows[-1 - i][0].split()[:10]) for i in range(30)]
    docs = spark.createDataFrame([(t, "clean") for t, _ in rows] + [(t, "noise") for t in noise] + [(t, "mixed") for t in mixed]
                                 + [(None, "null"), ("", "null"), ("12 !", "null")], "text string, kind string")
    got = langid.identified(docs, model)
    kept = {r.kind: r.n for r in got.filter(langid.confident(got.score, got.lang_pred, got.explained)).groupBy("kind").agg(
        F.count("*").alias("n")).collect()}
    assert kept.get("clean", 0) >= 0.97 * len(rows) and set(kept) == {"clean"}


def test_every_distinct_text_teaches_the_model_and_its_fences(spark):
    rnd = random.Random(24)
    texts = {f"always {' '.join(rnd.choice('abcdefgh') * 3 for _ in range(9))} {i // 50}" for i in range(2600)}
    rows = [(t, "aa") for t in texts] + [(min(texts), "aa")] * 2500
    # More than one in a hundred of the texts, but not of the rows, hold as many unknown words as known ones.
    strange = ["aaa " + "".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(40)]
    model = langid.fit_fences(langid.fit(spark.createDataFrame(rows + [(t, "aa") for t in strange], "text string, lang string").repartition(3)))
    row = model.items[:int((model.kind == 0).sum())].to_pylist().index("always")
    assert model.langs == ["aa"] and round(math.exp(model.gain[model.first[row]]) / 2 - 0.5) == len(texts)
    assert model.fences["aa"] == langid.FENCE_PART / 2


def test_most_frequent_entries_match_a_sort(spark):
    rnd = random.Random(25)
    rows = [(lang, kind, f"i{i}", min(9, int(1 / rnd.random()))) for lang in "ab" for kind in (0, 1) for i in range(200)]
    limits = langid.FitLimits(words_per_lang=30, grams_per_lang=70)
    got = langid._most_frequent(spark.createDataFrame(rows, "lang string, kind int, item string, n long").repartition(3), limits)
    want = set()
    for lang in "ab":
        for kind, top in ((0, 30), (1, 70)):
            some = sorted((r for r in rows if r[:2] == (lang, kind)), key=lambda r: (-r[3], r[2]))[:top]
            want |= {r for r in some if kind or r[3] > 1}
    assert {tuple(r) for r in got.collect()} == want


def test_two_hundred_languages_make_a_sparse_model(spark):
    rnd = random.Random(23)
    rows = _invented(rnd, 200, 4, 12)
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert len(model.langs) == 200 and len(model.at) < 6 * len(model.items)
    assert sum(model.predict(t)[0] == l for t, l in rows) >= 0.99 * len(rows)


def _brute_components(rows):
    def shingles(t):
        w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: find(d) for d in root}


def test_near_duplicates_match_brute_force(docs, spark):
    rnd = random.Random(17)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    at = 1000
    for _ in range(25):
        base = [f"w{rnd.randint(0, 5000)}" for _ in range(rnd.choice([3, 7, 12, 40, 150]))]
        for _ in range(rnd.randint(1, 8)):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(words) // 30))):
                words[rnd.randrange(len(words))] = f"x{rnd.randint(0, 5000)}"
            rows.append((at, " ".join(words)))
            at += 1
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = _brute_components(rows)
    got = neardup.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
        assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert neardup.near_duplicates(_empty(docs)).count() == 0


def test_register_estimate_is_close():
    rng = np.random.default_rng(5)
    for j in (0.2, 0.5, 0.75, 0.95):
        got = []
        for _ in range(30):
            n = 2000
            both = int(n * 2 * j / (1 + j))
            pool = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(pool[:n]), np.unique(pool[n - both:])
            got.append(float(neardup.estimate(neardup.registers(a), neardup.registers(b))))
        assert abs(np.mean(got) - j) < 0.03


def _brute_best_fit(rows, capacity):
    """Best fit by scanning every bin: tightest compatible one, oldest first among equals in residual."""
    tails = sorted((-(n % capacity), i) for i, (n, _, _) in enumerate(rows) if n % capacity)
    bins = []
    for tail, i in tails:
        n, s, c = -tail, rows[i][1], rows[i][2]
        ok = [b for b in bins if b["left"] >= n and (s is None or s not in b["s"]) and (c is None or c not in b["c"])]
        if ok:
            b = min(ok, key=lambda b: (b["left"], b["put"]))
        else:
            b = {"left": capacity, "s": set(), "c": set(), "items": []}
            bins.append(b)
        b["left"] -= n
        b["put"] = len(tails) and sum(len(x["items"]) for x in bins)
        b["s"].add(s)
        b["c"].add(c)
        b["items"].append(i)
    return sorted(sorted(b["items"]) for b in bins)


def test_best_fit_equals_brute_force():
    rnd = random.Random(6)
    for _ in range(40):
        rows = [(rnd.randint(0, 230), rnd.choice(["hot", "hot", "a", "b", "c", None]), rnd.choice([1, 2, 3, 4, 5, 6, None]))
                for _ in range(rnd.randint(0, 60))]
        got = packing.pack_block(range(len(rows)), *map(list, zip(*rows)), 100) if rows else []
        bins = {}
        for row, piece, start, n, b, offset in got:
            if n and n < 100:
                bins.setdefault(b, []).append(row)
        assert sorted(map(sorted, bins.values())) == _brute_best_fit(rows, 100)


def test_packing_covers_every_byte(docs):
    out = packing.packed(docs, F.octet_length("text"), packing.text_cluster(), capacity=512, keep=("doc_id", "kept")).collect()
    assert sum(r.length for r in out) == sum(len((r.text or "").encode()) for r in docs.collect())
    used = {}
    for r in out:
        if r.bin_id is not None:
            used.setdefault(r.bin_id, []).append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 512
    assert packing.packed(_empty(docs), F.octet_length("text"), packing.text_cluster()).count() == 0
