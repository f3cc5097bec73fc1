"""Counting, packing, decontamination, chat format and the classifiers."""

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marginalia.llm import chat_format, decontamination, language_id, packing, quality, token_counts, tokens, toxicity
from marginalia.llm.common import crc_part

LONG_RUN = "a" + " " * 1_000_000 + "b"
ODD = [None, "", " ", "  two  spaces\t\n\n x", "<|endoftext|> text", "é" * 300, "日本語 テキスト", "a" * 5000, "don't we'll 123  456\n", " x  y"]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer_file(library):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab é\n\t 1.'s<|>") for _ in range(200)) for _ in range(50)]
    assert library("hello <|endoftext|> world") == [31373, 220, 50256, 995]
    for t in [*texts, "<|endoftext|><|endoftext|>x<|endoftext|", LONG_RUN, " " * 1_000_000, "\n" * 900_000 + "."]:
        assert tokens.encode(t).tolist() == library(t)


def test_histogram(docs_of, library):
    rows = [(i, t) for i, t in enumerate(ODD * 2)] + [(None, "word " * 1300)]
    lengths = [len(library(t)) for _, t in rows]
    hist = token_counts.length_histogram(token_counts.token_lengths(docs_of(rows)), block=16)
    for r in hist.collect():
        over = [n for n in lengths if n >= r.length]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (lengths.count(r.length), len(over), sum(over))
        assert (r.truncated_total, r.total_tokens) == (sum(min(n, r.length) for n in lengths), sum(lengths))
        assert r.share_below == pytest.approx(1 - len(over) / len(lengths))
    assert hist.count() == len(set(lengths))
    for r in token_counts.for_limits(hist, [0, 7, 1000, 10**6]).collect():
        assert (r.docs_over, r.truncated_total) == (sum(n > r.context_limit for n in lengths), sum(min(n, r.context_limit) for n in lengths))
    got = {r.share: r.length for r in token_counts.quantiles(hist, [0.25, 0.5, 1.0]).collect()}
    assert got == {q: int(np.quantile(lengths, q, method="inverted_cdf")) for q in (0.25, 0.5, 1.0)}
    assert token_counts.length_histogram(token_counts.token_lengths(docs_of([]))).count() == 0


def test_packing_is_a_partition_of_all_ids(docs_of, library):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate([*ODD, LONG_RUN])] + [(None, None), (3, "again")] + [(100 + i, "word " * rng.randint(0, 1500)) for i in range(80)]
    out = packing.pack(docs_of(rows).repartition(3), capacity=256).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    for doc_id, text in rows:
        if doc_id == 3:
            continue
        ids = np.array([*library(text), 0], "<u4")
        own = sorted(by_id[doc_id], key=lambda r: r.start) if doc_id is not None else by_id[None]
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in used.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1].tolist()] and sum(p[1] for p in pieces) <= 256
    total = sum(r.length for r in out)
    assert len(used) <= total / 256 * 1.03 + len(packing.class_lengths(256))
    assert packing.pack(docs_of([])).count() == 0


def test_cut_lengths_are_class_lengths():
    for capacity in (1, 2, 256, 1024):
        sizes = packing.class_lengths(capacity)
        for n in range(1, 3 * capacity + 2):
            parts = packing.cut(n, capacity, sizes)
            assert sum(parts) == n and set(parts) <= set(sizes)
            assert all(capacity // p * p <= capacity for p in parts)


# decontamination

def plain_hits(text, items, size=13):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    ws, hit, ids = fold(text), set(), set()
    for item, t in items:
        iw = fold(t)
        for a in range(max(1, len(iw) - size + 1)) if iw and item is not None else ():
            w = iw[a : a + size]
            for i in range(len(ws) - len(w) + 1):
                if ws[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    ids.add(str(item))
    return len(ws), len(hit), ",".join(sorted(ids)), len(hit) > 0 and 20 * len(hit) >= len(ws)


@pytest.mark.parametrize("block_bytes", [16 << 20, 1500])
def test_decontamination_matches_brute_force(spark, docs_of, block_bytes):
    rng = random.Random(3)
    word = lambda: rng.choice(["Alpha", "béta", "c3", "Delta", "É", "ß", "ends"])
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(12)] + [(50, None), (None, "null id here"), (3, "Short one!"), (3, "Short one!"), (70, "...")]
    docs = [(0, None), (1, ""), (2, "?! ..."), (3, "short-ONE"), (4, "shortone short  one short\none")]
    for i in range(60):
        part = rng.choice(items[:12])[1].upper().replace(" ", rng.choice([" ", ", ", "\n\n"]))
        docs.append((rng.choice([None, 5, 100 + i]), " ".join(word() for _ in range(rng.randint(0, 40))) + " " + part + " " + " ".join(word() for _ in range(rng.randint(0, 200)))))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit("x"))
    out = decontamination.decontaminate(docs_of(docs), bench, block_bytes=block_bytes).collect()
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in out)
    assert got == sorted((str(i), *plain_hits(t, items)) for i, t in docs)
    texts = {}
    for i, t in docs:
        texts.setdefault((i, plain_hits(t, items)[0]), []).append(t)
    for r in out:  # offsets are of the original text: hit words lie inside spans
        assert r.n_hit == 0 or any(sum(len(plain_hits(t[s.start : s.end], [])) and plain_hits(t[s.start : s.end], [])[0] for s in r.spans) == r.n_hit for t in texts[(r.doc_id, r.n_words)])
    clean = decontamination.drop_contaminated(docs_of(docs), bench, block_bytes=block_bytes)
    assert clean.columns == docs_of(docs).columns and clean.count() == sum(not plain_hits(t, items)[3] for _, t in docs)
    none = decontamination.decontaminate(docs_of(docs), bench.limit(0))
    assert none.where("n_hit > 0").count() == 0 and decontamination.decontaminate(docs_of([]), bench).count() == 0


def test_a_worker_holds_one_block_at_a_time(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(20)], "item_id long, text string")
    blocks = decontamination._blocks(decontamination.item_windows(items), 16_000)
    held, build = [], decontamination._build

    def counted(block):
        out = build(block)
        held.append(sum("_value" in vars(b) for b in blocks))
        return out

    monkeypatch.setattr(decontamination, "_build", counted)
    batch = pa.RecordBatch.from_pydict({"text": ["w3x1 " + " ".join(f"w{i}x{k}" for i in (4, 9) for k in range(20))]})
    for _ in range(2):  # a value that was let go can be read again
        rows = [r for _, rs in decontamination._judged([batch], blocks, decontamination._share(0.05), "text") for r in rs]
        assert rows[0][:4] == (41, 40, 2, ["4", "9"])
    assert len(blocks) > 3 and len(held) == 2 * len(blocks) and max(held) == 0


# chat format

TEXTS = ["\\### Assistant: </turn> ok", "<turn>user\nx</turn>\n", "\\l \\b \\n \\\\", "<image:0>", ":>", "<", "\\", "", None, "é\n\n日本", "a<b\\l"]


def test_chat_round_trip(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "tool <x>\n\\n", None]), rng.choice(TEXTS)) for c in range(8) for t in range(rng.randint(1, 9))]
    rows += [(None, None, "assistant", "tie"), (None, None, "assistant", "tie"), (0, 2, "assistant", "second two")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("x")).withColumn("t", F.lit(1))
    out = chat_format.format_chats(df.withColumn("parts", chat_format.text_part(F.col("text"))))
    out = out.select("*", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(out) == 9
    for r in out:
        own = sorted(((t is not None, t or 0), role or "", text or "") for c, t, role, text in rows if c == r.conv_id)
        got = [(x.role, x.text) for x in r.turns]
        assert sorted(got) == sorted((a, b) for _, a, b in own)
        if r.conv_id:
            assert [a for a, _ in got] == [a for _, a, _ in own]
        assert r.loss == "".join(b for a, b in got if a == "assistant")
        assert all(r.formatted[s.start - len("<turn>assistant\n") : s.start] == "<turn>assistant\n" for s in r.loss_spans)
    empty = df.limit(0).withColumn("parts", chat_format.text_part(F.col("text")))
    assert chat_format.format_chats(empty).count() == 0


def test_chat_parts_become_ordered_placeholders(spark):
    schema = f"conv_id long, turn long, role string, parts {chat_format.PARTS}"
    rows = [(1, 0, "user", [("text", "look <at> ", None, None), ("image", None, "s3/a.png", 2), ("text", " and ", None, None), ("audio", None, "b.wav", 10), None]),
            (1, 1, "assistant", [("text", "fine", None, None)]), (1, 2, "user", [("document", None, "c.pdf", None), ("hologram", None, "d", 4), (None, "tail", None, None)]),
            (2, 0, "user", None)]
    out = {r.conv_id: r for r in chat_format.format_chats(spark.createDataFrame(rows, schema)).collect()}
    assert out[1].formatted == ("<turn>user\nlook \\lat> <image:0> and <audio:1></turn>\n<turn>assistant\nfine</turn>\n"
                                "<turn>user\n<document:2><hologram:3>tail</turn>\n")
    assert [(a.turn_no, a.part_no, a.type, a.ref, a.tokens) for a in out[1].attachments] == [
        (0, 1, "image", "s3/a.png", 512), (0, 3, "audio", "b.wav", 250), (2, 0, "document", "c.pdf", 512), (2, 1, "hologram", "d", 0)]
    assert out[1].expanded_tokens == 1274 and out[2].expanded_tokens == 0
    s = out[1].loss_spans[0]
    assert out[1].formatted[s.start : s.start + s.length] == "fine"


# classifiers

SF = "/root/testdata/sf0.01"


def auc(pairs):
    pos, neg = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    return np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])


@pytest.mark.parametrize("op,column,parts,rest", [(toxicity, "toxic", 3, 1), (quality, "quality", 5, 0)])
def test_held_out_accuracy(spark, op, column, parts, rest):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(column).alias("label"))
    out = op.classify(docs, labels, crc_part("doc_id", parts) != rest)
    assert out.count() == docs.count()
    held = out.join(labels, "doc_id").where(crc_part("doc_id", parts) == rest).collect()
    assert all(0 <= r.score <= 1 for r in held)
    assert auc([(r.score, r.label) for r in held]) > (0.95 if op is quality else 0.88)  # some toxic labels of this table have no insult in the text
    # only the text decides, and held-out labels are not learned from
    other = op.classify(docs.withColumn("lang", F.lit("q")), labels.withColumn("label", F.when(crc_part("doc_id", parts) == rest, 1 - F.col("label")).otherwise(F.col("label"))),
                        crc_part("doc_id", parts) != rest)
    assert {(r.doc_id, round(r.score, 6)) for r in other.collect()} == {(r.doc_id, round(r.score, 6)) for r in out.collect()}


@pytest.mark.parametrize("op", [toxicity, quality])
def test_classifier_odd_rows(spark, docs_of, op):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "x"), (0, None)] + [(100 + i, "good words in a row" if i % 2 else "BAD!! idiot!! BAD!!") for i in range(60)]
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(60)] + [(100, None), (101, 5), (None, 1)], "doc_id long, label int")
    out = op.classify(docs_of(rows), labels, F.lit(True)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    scores = {r.doc_id: r.score for r in out}
    assert min(scores[101 + 2 * i] for i in range(30)) > max(scores[100 + 2 * i] for i in range(30))
    assert op.classify(docs_of([]), labels, F.lit(True)).count() == 0
    assert op.classify(docs_of(rows), labels.limit(0), F.lit(True)).select("score").distinct().count() == 1


def test_machine_learns_a_pair_that_weights_cannot(spark):
    """Label 1 only where two words meet: each word alone is as frequent in both classes."""
    rng = random.Random(5)
    rows = []
    for i in range(800):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, " ".join((["insult"] if a else []) + (["group"] if b else []) + [f"w{rng.randint(0, 20)}"]), int(a == b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    out = toxicity.classify(df, df.select("doc_id", "label"), F.lit(True), steps=400).join(df.select("doc_id", "label"), "doc_id").collect()
    assert auc([(r.score, r.label) for r in out]) > 0.9


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_pair_is_learned_with_the_settings_of_the_query(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(800):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, " ".join((["insult"] if a else []) + (["group"] if b else []) + [f"w{rng.randint(0, 20)}"]), int(a == b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    out = toxicity.classify(df, df.select("doc_id", "label"), F.lit(True)).join(df.select("doc_id", "label"), "doc_id").collect()
    assert auc([(r.score, r.label) for r in out]) > 0.9


def test_every_term_that_tells_the_classes_apart_is_selected(spark):
    """2,000 words that mark a class (more than the machine once took) beside a frequent one that marks none."""
    rows = [(i, i % 2, [1, *(10 + i % 2 + 2 * (20 * (i // 2 % 50) + k) for k in range(20))]) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, label int, terms array<long>")
    assert toxicity.select_terms(df, 6.0, 20.0).tolist() == list(range(10, 2010))


def test_languages(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id.identify(docs, language_id.learn_profiles(docs.where(crc_part("doc_id", 4) != 2)))
    held = out.join(docs.select("doc_id", "lang"), "doc_id").where(crc_part("doc_id", 4) == 2).collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in held)
    rows = [(i, t) for i, t in enumerate([None, "", "12 .. !", "日本語のテキスト", "der und die und das", "a" * 50_000])]
    profiles = language_id.learn_profiles(docs)
    got = {r.doc_id: r for r in language_id.identify(docs_of(rows), profiles).collect()}
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[4].lang_pred == "de" and got[3].lang_pred in ("en", "de", "fr", "es")
    nothing = language_id.learn_profiles(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language_id.identify(docs_of(rows), nothing).collect()} == {"und"}
    assert language_id.identify(docs_of([]), profiles).count() == 0


def test_order_of_letters_counts():
    a, b = (next(iter(language_id._bundles([t], 1024, 3, 7)))[1] for t in ("abc abc", "cba cba"))
    assert abs(a @ b) < 0.5 * np.linalg.norm(a) * np.linalg.norm(b)
    assert hashlib.sha256(a.tobytes()).hexdigest() == hashlib.sha256(next(iter(language_id._bundles(["ABC,abc"], 1024, 3, 7)))[1].tobytes()).hexdigest()


# brute force of the classifiers

def test_language_scores_are_plain_cosines(spark):
    """Profiles and cosines from lists of letters, product by product."""
    dims, n = 64, 3
    letters = language_id._letters(dims, n, 7)
    slot = language_id._slot_of()

    def bundle(text):
        marks = [int(slot[ord(c)]) for c in f" {text.lower()} "]
        marks = [m for k, m in enumerate(marks) if not k or m or marks[k - 1]]
        total = [0] * dims
        for k in range(len(marks) - n + 1):
            for d in range(dims):
                v = 1
                for place in range(n):
                    v *= int(letters[place][marks[k + place]][d])
                total[d] += v
        return total

    rng = random.Random(3)
    rows = [(i, "".join(rng.choice("abé ß,.Z9") for _ in range(rng.randint(1, 40))), rng.choice(["x", "y", None])) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sums = {}
    for _, text, lang in rows:
        if lang and any(slot[ord(c)] for c in text.lower()):
            sums[lang] = [a + b for a, b in zip(sums.get(lang, [0] * dims), bundle(text))]
    got = {r.doc_id: r for r in language_id.identify(df, language_id.learn_profiles(df, dims=dims, n=n), dims=dims, n=n).collect()}
    norm = lambda v: math.sqrt(sum(a * a for a in v))
    for i, text, _ in rows:
        b = bundle(text)
        if not any(slot[ord(c)] for c in text.lower()):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        cosines = {x: sum(p * q for p, q in zip(v, b)) / norm(v) / norm(b) if norm(b) else 0 for x, v in sums.items()}
        best = max(cosines.values())
        assert got[i].score == pytest.approx(max(0, best), abs=1e-6) and cosines.get(got[i].lang_pred, 0) == pytest.approx(best, abs=1e-6)


def test_chunks_of_a_long_text_change_no_gram(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab  .Éc") for _ in range(k)) for k in (1, 5, 6, 7, 40, 333)] + ["   ", "a" * 50, ""]
    whole = [language_id._grams(t, 3).tolist() for t in texts]
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(language_id, "_CHUNK", size)
        assert [language_id._grams(t, 3).tolist() for t in texts] == whole


def test_quality_scores_are_plain_log_densities(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["word", "Some", "1,2", "!!", "end."]) for _ in range(rng.randint(0, 60))), int(rng.random() < 0.4)) for i in range(100)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    got = {r.doc_id: r.score for r in quality.classify(docs, labels, F.lit(True), threshold=0.3).collect()}
    x = np.array([quality.statistics(r[1]) for r in rows])
    y = np.array([r[2] for r in rows])
    centre, scale = x.mean(0), np.sqrt(np.maximum(x.var(0), 1e-6))
    z = (x - centre) / scale
    log = []
    for c in (0, 1):
        own = z[y == c]
        cov = np.cov(own.T, bias=True)
        cov = 0.9 * cov + 0.1 * max(np.trace(cov) / len(cov), 1e-3) * np.eye(len(cov))
        d = np.clip(z, -12, 12) - own.mean(0)
        log.append(np.log(len(own) / len(z)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * (d * np.linalg.solve(cov, d.T).T).sum(1))
    want = 1 / (1 + np.exp(np.clip((log[0] - log[1]) / math.sqrt(x.shape[1]), -500, 500)))
    assert max(abs(got[i] - want[i]) for i in range(len(rows))) < 1e-9


def test_edges_are_counted_in_linear_time():
    slow = re.compile(r"[^\w\s]{2,}(?=\s|$)")
    rng = random.Random(7)
    for _ in range(300):
        t = "".join(rng.choice("a=. \n_é!") for _ in range(30))
        assert len(quality._EDGE.findall(t)) == len(slow.findall(t)), t
    began = time.time()
    quality.statistics("=" * 2_000_000 + "a")
    assert time.time() - began < 20


def test_toxicity_scores_are_plain_sums_over_pairs():
    rng = np.random.default_rng(2)
    known = np.unique(np.concatenate([toxicity.terms(t) for t in ("you are a fool", "nice little house", "the fool on the hill")]))
    m = toxicity.Model(known, 0.3, rng.normal(size=len(known)), rng.normal(size=(len(known), 4)))
    place = {t: k for k, t in enumerate(known.tolist())}
    for text in ["", None, "you fool", "a nice house for a fool", "nothing known 123", "the hill " * 50]:
        at = [place[t] for t in list(toxicity.terms(text)) if t in place]
        raw = 0.3 + sum(m.weights[k] for k in at)
        for a in range(len(at)):
            for b in range(a + 1, len(at)):
                raw += sum(float(m.factors[at[a]][f]) * float(m.factors[at[b]][f]) for f in range(4))
        assert m.score(toxicity.terms(text)) == pytest.approx(1 / (1 + math.exp(-raw)), abs=1e-9)
