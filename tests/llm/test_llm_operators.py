from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stridelake.llm import chat_tree, exact_dedup, language_id, lm_score, mixing, near_dedup, ogg_media, packing, quality_knn, suffix_dedup
from stridelake.llm.common import materialize
from stridelake.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and repeated rows, ties, and a clashing column."""
    rows = [(1, "a b c", "en", "s", 5, "x"), (1, "a b c", "en", "s", 5, "x"), (None, None, None, None, None, None), (2, "", "en", None, 0, "y"), (3, "!!! ???", None, "s", 7, None), (3, "other text here", "fr", "t", 15, None), (4, "w " * 6000, "en", "t", 12000, "z"), (None, "a b c", "en", "s", 5, "x")]
    return frame(spark, rows, DOCS + ", _digest string")


def empty(df):
    return df.where("false")


# --- exact deduplication


@pytest.mark.parametrize("heavy", [2, 512])
def test_exact_groups(spark, heavy):
    rng = random.Random(1)
    rows = [(i, rng.choice(["x", "y", "z", None, "", *map(str, range(40))])) for i in range(400)] + [(5, "tie"), (5, "tie"), (None, "tie")]
    got = exact_dedup.exact_groups(frame(spark, rows), heavy).collect()
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(got) == len(rows)
    for r in got:
        ids = digest[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and set(kept) == set(digest)


def test_exact_edges(odd):
    out = exact_dedup.drop_copies(odd)
    assert out.columns == odd.columns
    assert sorted((r["text"] or "", r["doc_id"]) for r in out.collect()) == sorted([("a b c", 1), ("", 2), ("!!! ???", 3), ("other text here", 3), ("w " * 6000, 4)])
    assert exact_dedup.exact_groups(empty(odd)).count() == 0 and exact_dedup.drop_copies(empty(odd)).count() == 0


def test_exact_is_native(odd):
    for df in (exact_dedup.exact_groups(odd), exact_dedup.drop_copies(odd)):
        assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()


# --- mixing


def filled(sizes, weights, share, cap):
    """Targets by resharing what is above the caps, again and again."""
    budget, target, capped = share * sum(sizes.values()), {}, set()
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    while True:
        free = [s for s in names if s not in capped]
        left = budget - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] for s in capped} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s] + 1e-9]
        if not over:
            return target
        capped |= set(over)


def test_mix_targets_and_takes(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "b", "c", "d", None])) for i in range(900)]
    got = mixing.mix_sources(frame(spark, rows, "doc_id long, text string, source string"), range_rows=20).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = filled(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.CAP)
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mixing.mix_sources(frame(spark, rows, "doc_id long, text string, source string").repartition(7), range_rows=500).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}


def test_mixed_documents_follow_the_budget(spark):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(400)]
    df = frame(spark, rows, "doc_id long, text string, source string")
    budgets = {r["source"]: r["target"] for r in mixing.mix_sources(df).collect()}
    out = Counter()
    for r in mixing.mixed_documents(df).collect():
        out[r["source"]] += len(r["text"].split())
    assert all(abs(out[s] - budgets[s]) <= 9 for s in budgets)


def test_mix_edges(odd):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == odd.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert mixing.mixed_documents(odd).columns == odd.columns
    assert mixing.mix_sources(empty(odd)).count() == 0 and mixing.mixed_documents(empty(odd)).count() == 0


# --- chat trees


def test_chat_round_trip(spark):
    rng = random.Random(3)
    words = [*chat_tree.CONTROL, "\\", "\\\\", "hi", " ", "\n", "[IN", "</", "é"]
    rows = []
    for c in range(60):
        first = f"opening {c % 3}" if c % 4 else "".join(rng.choice(words) for _ in range(8))
        rows += [(c, 0, "user", first)] + [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), "".join(rng.choice(words) for _ in range(rng.randint(0, 8))) or None) for t in range(1, rng.randint(1, 6))]
    rows += [(100 + i, t, r, x) for i in range(3) for c, t, r, x in rows if c == 7] + [(None, None, "user", "n"), (200, 0, "user", "d"), (200, 0, "user", "d")]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    for tokens in (30, 10_000):
        nodes, members = chat_tree.format_chats(df, block_tokens=tokens)
        got = {r["conv_id"]: r for r in members.join(chat_tree.read_back(nodes), "leaf").collect()}
        want: dict = {}
        for c, t, r, x in sorted(rows, key=lambda v: (v[0] or -1, v[1] or -1)):
            want.setdefault(c, []).append((r or "", x or ""))
        assert set(got) == set(want)
        for c, turns in want.items():
            loss = "".join(x for r, x in turns if r == "assistant")
            assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
            assert (got[c]["loss_chars"], got[c]["loss_sha256"], got[c]["n_turns"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(turns))
    shared = nodes.where("depth = 0").count()
    assert shared < len(want)  # common first turns come once


def test_shared_turns_are_emitted_once(spark):
    rows = [(c, t, "user", "same" if t < 2 else f"own {c}") for c in range(5) for t in range(3)]
    nodes, _ = chat_tree.format_chats(frame(spark, rows, "conv_id long, turn long, role string, text string"))
    got = sorted(nodes.collect(), key=lambda r: r["place"])
    assert [r["depth"] for r in got] == [0, 1, 2, 2, 2, 2, 2]
    assert len({(r["position"]) for r in got if r["depth"] == 2}) == 1
    assert [(x["start"], x["end"]) for x in got[-1]["attend"]] == [(0, got[1]["start"] + got[1]["length"])]


def test_a_path_repeated_at_every_cut_goes_out_in_small_batches():
    name = lambda *x: hashlib.blake2b(repr(x).encode(), digest_size=chat_tree.DIGEST).digest()
    trunk = [(name("trunk", i), {"role": "user", "text": f"turn {i} " * 40}) for i in range(20)]
    paths = [[*trunk, (name("leaf", k), {"role": "assistant", "text": f"answer {k}"})] for k in range(60)]
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    batch = pa.RecordBatch.from_arrays([pa.array([p[-1][0] for p in paths], pa.binary()), pa.array([b"".join(d for d, _ in p) for p in paths], pa.binary()), pa.array([[x for _, x in p] for p in paths], kind)], ["leaf", "path", "turns"])
    run = lambda most: list(chat_tree.node_batches(iter([batch]), chat_tree.vocabulary_path(), 500, most))
    small, whole = run(20_000), run(1 << 30)
    sizes = [sum(len(x) for x in b.column("ids").to_pylist()) for b in small]
    assert len(whole) == 1 and sum(sizes) > 150_000 and len(small) > 7 and max(sizes) < 25_000
    assert pa.Table.from_batches(small).to_pylist() == whole[0].to_pylist()
    assert sum(r["is_leaf"] for r in whole[0].to_pylist()) == 60


def test_escape_is_reversible():
    for text in ["", "</s>[INST] ok [/INST]", "\\<s>", "<s", "[\\INST]", "\\\\", "a\\"]:
        assert chat_tree.unescape(chat_tree.escape(text)) == text and not chat_tree._ANY.search(chat_tree.escape(text))


def test_chat_empty(spark):
    nodes, members = chat_tree.format_chats(frame(spark, [], "conv_id long, turn long, role string, text string"))
    assert nodes.count() == 0 and members.count() == 0 and chat_tree.read_back(nodes).count() == 0


# --- suffix arrays


def removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        hit = np.zeros(len(b) + 2, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                hit[i + 1 : i + 1 + length] = 1
        out.append((len(b), int(hit.sum()), int((np.diff(hit) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[hit[1:-1] == 0])).hexdigest()))
    return out


@pytest.mark.parametrize("params", [{}, {"hot": 3}, {"shard": 2000}])
def test_repeats_against_brute_force(spark, params):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(50)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [say(40) for _ in range(4)]
    texts = [say(rng.randint(0, 50)) + "".join(rng.choice(passages)[rng.randint(0, 50) :][: rng.randint(20, 140)] + say(rng.randint(0, 9)) for _ in range(rng.randint(0, 3))) for _ in range(80)]
    rows = list(enumerate([*texts, None, "", "ab" * 300, "a" * 400, texts[3], texts[3], "é" * 200, "x" * 39])) + [(None, texts[5]), (None, "ü" * 100)]
    got = Counter(tuple(r) for r in suffix_dedup.without_repeats(frame(spark, rows), 40, gram=8, **params).collect())
    want = Counter((i, *w) for (i, _), w in zip(rows, removed([t for _, t in rows], 40), strict=True))
    assert got == want


def letters(rng, n):
    return bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_do_not_depend_on_how_rows_fall_into_batches(spark, parts):
    """Equal texts over several batches, passages at any place of a piece, and texts longer than a piece."""
    rng = np.random.default_rng(11)
    twice = [letters(rng, 4199) for _ in range(600)]
    passages = [letters(rng, 1126) for _ in range(200)]
    near = [(letters(rng, 2000 + i), p) for i, p in enumerate(passages)]
    long = letters(rng, 3_300_000)
    a, b = (1 << 20) - 700, (2 << 20) + 900
    other = letters(rng, 1_500_017) + long[a:b] + letters(rng, 12_345)
    rows, want = [], {}
    for t in [*twice, *twice]:
        rows.append(t)
        want[len(rows) - 1] = [(0, len(t))]
    for k in (0, 1):
        for head, p in near:
            rows.append(head[k * 900 :] + p + letters(rng, 500))
            start = len(head) - k * 900
            # what is left of the head after 900 bytes is in the first one too
            want[len(rows) - 1] = [(900 if k == 0 else 0, start + len(p))]
    rows += [long, other]
    want[len(rows) - 2], want[len(rows) - 1] = [(a, b)], [(1_500_017, 1_500_017 + b - a)]
    df = frame(spark, list(enumerate(rows))).repartition(parts, "doc_id") if parts > 1 else frame(spark, list(enumerate(rows))).coalesce(1)
    for r in suffix_dedup.without_repeats(df, with_kept=True).collect():
        text, spans = rows[r["doc_id"]], [(s["start"], s["end"]) for s in r["spans"]]
        # a letter beside a passage agrees by chance in one of 26
        assert len(spans) == len(want[r["doc_id"]]), r["doc_id"]
        for (x, y), (u, v) in zip(spans, want[r["doc_id"]], strict=True):
            assert u - 8 <= x <= u and v <= y <= v + 8, r["doc_id"]
        assert r["kept"].decode() == text[: spans[0][0]] + text[spans[0][1] :] and r["n_removed"] == spans[0][1] - spans[0][0]


def test_suffix_order_and_prefixes():
    rng = random.Random(5)
    for _ in range(40):
        x = np.array([rng.choice(b"ab") for _ in range(rng.randint(1, 200))], np.uint8)
        order, rank = suffix_dedup.suffix_array(x, 40)
        padded = bytes(x) + bytes(50)
        assert [padded[i : i + 40] for i in order] == sorted(padded[i : i + 40] for i in range(len(x)))
        shared = suffix_dedup.common_prefixes(x, order, rank, 40, lanes=rng.choice([1, 7, 50]))
        for k in range(1, len(x)):
            a, b = bytes(x)[order[k - 1] :], bytes(x)[order[k] :]
            same = next((i for i in range(min(len(a), len(b), 40)) if a[i] != b[i]), min(len(a), len(b), 40))
            assert shared[k] == same


def test_repeats_edges(odd):
    assert suffix_dedup.without_repeats(odd).count() == odd.count() and suffix_dedup.without_repeats(empty(odd)).count() == 0
    got = suffix_dedup.without_repeats(odd, with_kept=True).where("doc_id = 4").first()
    assert got["n_removed"] == 12000 and got["kept"] == b"" and [(s["start"], s["end"]) for s in got["spans"]] == [(0, 12000)]


def test_passages_shorter_than_the_removed_strings_are_counted(spark):
    """Words in runs of 12 that another document holds too, against brute force."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [say(30) for _ in range(5)]
    parts = [[say(rng.randint(0, 20))] + [rng.choice(passages)[rng.randint(0, 15) :][: rng.randint(8, 18)] + say(rng.randint(0, 3)) for _ in range(rng.randint(0, 4))] for _ in range(80)]
    texts = ["".join(w + rng.choice([" ", "\n", "\t ", "\r\n"]) for p in ps for w in p) for ps in parts]
    texts += [" ".join(say(13)), "é " * 12, "é " * 14, "a " * 40, " ".join(["b"] * 11), " ".join(["b"] * 11), None, "", " \n", texts[3], texts[3], texts[3].upper(), "x\u00a0" * 30, "x\u00a0" * 30]
    for k in range(20):  # a passage twice in a text, of which another text holds a part
        p = [f"{k}-{i}" for i in range(60)]
        texts += [" ".join([*p, *say(5), *p]), " ".join([*say(3), *p[10 + k % 7 :][: 14 + k]])]
    rows = [*enumerate(texts), (None, texts[5])]
    runs = [(t or "").encode().split() for _, t in rows]
    holders = {}
    for d, ws in enumerate(runs):
        for i in range(len(ws) - 11):
            holders.setdefault(tuple(ws[i : i + 12]), set()).add(d)
    want = []
    for (i, _), ws in zip(rows, runs, strict=True):
        hit = {j for k in range(len(ws) - 11) if len(holders[tuple(ws[k : k + 12])]) > 1 for j in range(k, k + 12)}
        want.append((i, len(hit)))
    got = suffix_dedup.without_repeats(frame(spark, rows).repartition(3), words=12).select("doc_id", "n_shared_words").collect()
    assert Counter((r["doc_id"], r["n_shared_words"]) for r in got) == Counter(want)
    assert sum(n > 0 for _, n in want) > 30 and sum(n == 0 for _, n in want) > 5


def test_records_of_words_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_WORDS", 40)
    monkeypatch.setattr(suffix_dedup, "PIECE", 100)
    rng = random.Random(10)
    texts = [" ".join(rng.choice(["a", "bb", "é", "x" * 150]) for _ in range(n)) + " \n" for n in (0, 11, 12, 13, 200, 3, 90)]
    text, hashes = suffix_dedup.words_of(*suffix_dedup.text_bytes(pa.array(texts)))
    assert text.tolist() == [i for i, t in enumerate(texts) for _ in t.split()] and len(set(hashes.tolist())) == 4
    owner, _, _, _, first, windows = suffix_dedup.word_records(text, hashes, 12, 8)
    got = [(i, k) for i, f, n in zip(owner.tolist(), first.tolist(), windows.tolist(), strict=True) for k in range(f, f + n)]
    assert sorted(got) == [(i, k) for i, t in enumerate(texts) for k in range(len(t.split()) - 11)]


def test_a_passage_of_over_50_words_below_400_bytes_is_seen(spark):
    rng = random.Random(9)
    say = lambda n: " ".join(f"{rng.randrange(10**5):05d}" for _ in range(n))
    passage, short = say(51), say(50)
    rows = [(0, say(90) + " " + passage + " " + say(70)), (1, say(30) + "\n" + passage), (2, say(120) + " " + short + " " + say(20)), (3, short), (4, say(200))]
    got = {r["doc_id"]: (r["n_shared_words"], r["n_removed"]) for r in suffix_dedup.without_repeats(frame(spark, rows), words=suffix_dedup.WORDS).collect()}
    assert got == {0: (51, 0), 1: (51, 0), 2: (0, 0), 3: (0, 0), 4: (0, 0)}


def test_passages_edges(odd):
    got = suffix_dedup.without_repeats(odd, words=suffix_dedup.WORDS)
    assert got.columns[-1] == "n_shared_words" and {r["n_shared_words"] for r in got.collect()} == {0} and got.count() == odd.count()
    assert suffix_dedup.without_repeats(empty(odd), words=suffix_dedup.WORDS).count() == 0


# --- Ogg


def bitwise(data):
    c = 0
    for x in data:
        c ^= x << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c & 0x80000000 else c << 1) & 0xFFFFFFFF
    return c


def test_ogg_checksum_and_packets():
    rng = random.Random(6)
    data = rng.randbytes(999)
    assert ogg_media.page_checksum(data) == bitwise(data)
    a = [(rng.randbytes(n), i) for i, n in enumerate((3, 0, 255, 510, 70000, 65025, 1, 200000))]
    b = [(rng.randbytes(5), 0), (rng.randbytes(400), 7)]
    media = ogg_media.multiplex([ogg_media.write_stream(9, a), ogg_media.write_stream(4, b)])
    got = ogg_media.demultiplex(media)
    assert got[9].packets == [p for p, _ in a] and got[4].packets == [p for p, _ in b] and got[9].ended
    for at in (0, 5, 30, len(media) // 2, len(media) - 1):
        with pytest.raises(ogg_media.OggError):
            ogg_media.demultiplex(media[:at] + bytes([media[at] ^ 1]) + media[at + 1 :])


def test_ogg_times():
    s = ogg_media.Stream(packets=[b""] * 3, granules=[-1, -1, 3 * 480])
    assert s.times([480] * 3, 48000) == [(0.0, 0.01), (0.01, 0.02), (0.02, 0.03)]


def test_ogg_columns(spark, odd):
    for r, t in zip(ogg_media.read_media(ogg_media.with_media(odd), with_payload=True).collect(), odd.collect(), strict=True):
        raw = (t["text"] or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r["n_bytes"], r["payload"], r["tail_crc32"], r["error"]) == (len(raw), payload, zlib.crc32(payload[-32:]), None)
    bad = frame(spark, [(1, b"nothing"), (2, None)], "doc_id long, media binary")
    assert all(r["error"] and r["n_bytes"] is None for r in ogg_media.read_media(bad).collect())
    assert ogg_media.read_media(ogg_media.with_media(empty(odd))).count() == 0


# --- language models


def test_lm_prefers_the_target(spark):
    rng = random.Random(7)
    good, bad = [f"g{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(60))) for i in range(300)] + [(1000, None), (1001, "")]
    docs = frame(spark, rows)
    target = frame(spark, [(i,) for i in range(1, 200, 2)], "doc_id long")
    model = lm_score.fit(lm_score.with_target(docs, target))
    got = {r["doc_id"]: r for r in lm_score.score(docs, model).collect()}
    held = [i for i in range(200, 300)]
    assert max(got[i]["score"] for i in held if i % 2) < min(got[i]["score"] for i in held if not i % 2)
    assert got[1000]["n_tokens"] == 0 and got[1000]["score"] == 0 and got[1001]["target_loss"] == 0


def test_lm_losses_are_probabilities(spark):
    docs = frame(spark, [(0, "a b a b c"), (1, "b c d")])
    model = lm_score.fit(lm_score.with_target(docs, frame(spark, [(0,)], "doc_id long")))
    v = model["vocabulary"]
    for history in range(v.size + 1):
        weight = np.where(model["seen"][history], lm_score.BIGRAM_SHARE, 0)
        own = np.zeros((v.size, 2))
        for key, share in zip(model["key"], model["share"], strict=True):
            if key // (v.size + 1) == history:
                own[key % (v.size + 1)] = share
        p = weight * own + (1 - weight) * model["unigram"]
        assert np.allclose(p.sum(axis=0), 1, atol=1e-5)


def lm_losses(rows, targets):
    """n_tokens and the losses of each (doc_id, text), by dictionaries of all words and bigrams."""
    texts = [("".join(c if c.isalnum() else " " for c in t or "")).lower().split() for _, t in rows]
    models = []
    for chosen in ([i in targets for i, _ in rows], [True] * len(rows)):
        some = [w for w, c in zip(texts, chosen, strict=True) if c]
        models.append((Counter(x for w in some for x in w), Counter(p for w in some for p in zip([None, *w], w)), Counter(x for w in some for x in [None, *w][: len(w)])))  # noqa: B905
    size = len(models[1][0]) + 1
    out = []
    for w in texts:
        loss = []
        for single, both, history in models:
            weight = lambda h: lm_score.BIGRAM_SHARE if history[h] else 0  # noqa: E731, B023
            unigram = lambda x: (single[x] + lm_score.SMOOTH) / (sum(single.values()) + lm_score.SMOOTH * size)  # noqa: E731, B023
            loss.append(-sum(np.log(weight(h) * both[h, x] / max(history[h], 1) + (1 - weight(h)) * unigram(x)) for h, x in zip([None, *w], w)) / max(len(w), 1))  # noqa: B905
        out.append((len(w), *loss))
    return out


@pytest.mark.parametrize("params", [{}, {"chunk": 300, "part_bytes": 4000}])
def test_lm_against_brute_force(spark, params):
    rng = random.Random(8)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(120)] + [(None, "w1 w2 w1"), (None, None), (7, "W1, w1"), (500, "")]
    docs = lm_score.with_target(frame(spark, rows), frame(spark, [(i,) for i in range(0, 60, 2)] + [(None,)], "doc_id long"))
    got = lm_score.cross_entropy(docs, **params).collect()
    order = lambda r: (str(r[0]), r[1:])
    want = sorted(((i, *each) for (i, _), each in zip(rows, lm_losses(rows, set(range(0, 60, 2))), strict=True)), key=order)
    got = sorted(((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"]) for r in got), key=order)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want], rtol=1e-9)


def test_lm_query_keeps_every_word_and_bigram(spark, tmp_path):
    """More words than a broadcast model's 32,768, each once: the losses are those of all of them."""
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(100))) for i in range(400)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = lm_score.op6_lm_cross_entropy(spark, str(tmp_path)).collect()
    chosen = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5}
    unigram = lambda n, total: (n + lm_score.SMOOTH) / (total + lm_score.SMOOTH * 40_001)
    share = lm_score.BIGRAM_SHARE
    for r in got:
        n = int(r["doc_id"] in chosen)
        rest = [-np.log(share * k + (1 - share) * unigram(k, t)) if k else -np.log(unigram(0, t)) for k, t in ((n, 100 * len(chosen)), (1, 40_000))]
        first = [-np.log(share * k / d + (1 - share) * unigram(k, t)) for k, d, t in ((n, len(chosen), 100 * len(chosen)), (1, 400, 40_000))]
        assert [r["target_loss"], r["background_loss"]] == pytest.approx([(99 * a + b) / 100 for a, b in zip(rest, first, strict=True)])
    assert len(got) == 400


def test_lm_query_edges(spark, odd):
    none = frame(spark, [], "doc_id long")
    got = lm_score.cross_entropy(lm_score.with_target(odd, none))
    assert got.count() == odd.count() and all(r["score"] == 0 for r in got.where("n_tokens = 0").collect())
    assert lm_score.cross_entropy(lm_score.with_target(empty(odd), none)).count() == 0


def test_lm_edges(spark, odd):
    none = frame(spark, [], "doc_id long")
    assert lm_score.score(odd, lm_score.fit(lm_score.with_target(odd, none))).count() == odd.count()
    assert lm_score.score(empty(odd), lm_score.fit(lm_score.with_target(empty(odd), none))).count() == 0


# --- classifiers


def test_quality_held_out(spark, sf):
    got = {r["doc_id"]: r for r in quality_knn.op7_quality_knn(spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(got) == docs and all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    held = [(labels[i], got[i]["predicted"]) for i in labels if i in got and got[i]["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_quality_edges(spark, odd):
    no_labels = frame(spark, [], "doc_id long, label int")
    model = quality_knn.fit(odd.select("doc_id", "text"), no_labels)
    assert {r["score"] for r in quality_knn.scored(odd, model).collect()} == {0.5}
    assert quality_knn.good_documents(odd, model).columns == odd.columns
    labels = frame(spark, [(1, 1), (1, 0), (3, 0), (None, 1), (4, None), (99, 1)], "doc_id long, label int")
    model = quality_knn.fit(odd.select("doc_id", "text"), labels)
    assert all(0 <= r["score"] <= 1 for r in quality_knn.scored(odd, model).collect())
    assert quality_knn.scored(empty(odd), model).count() == 0


def test_cosines_are_exact(spark):
    rng = np.random.default_rng(8)
    texts = ["".join(rng.choice(list("abc XY1.!"), 80)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)]
    labels = frame(spark, [(i, int(i % 3 > 0)) for i in range(30)], "doc_id long, label int")
    model = quality_knn.fit(frame(spark, rows), labels)
    raw = b"".join(t.encode() for t in texts)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    x = quality_knn.terms(np.frombuffer(raw, np.uint8), offsets) @ model["basis"]
    got = quality_knn.score(model, np.frombuffer(raw, np.uint8), offsets)
    for i in range(40):
        c = np.array([float(x[i] @ r / np.linalg.norm(x[i])) for r in model["refs"]])
        near = np.argsort(-c)[: quality_knn.NEIGHBOURS]
        w = np.maximum(c[near], 1e-6) ** quality_knn.POWER * model["weight"][near]
        assert got[i] == pytest.approx(float((w * model["y"][near]).sum() / w.sum()), abs=1e-3)


def test_language_held_out(spark, sf):
    got = {r["doc_id"]: r for r in language_id.op8_language_id(spark, sf).collect()}
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [got[i]["lang_pred"] == v for i, v in lang.items() if got[i]["held_out"] and v]
    assert set(got) == set(lang) and sum(held) / len(held) > 0.95


def naive_language(train, texts):
    """Languages and scores by dictionaries."""
    words_in = lambda t: "".join(c.lower() if len(c.lower()) == 1 else c for c in "".join(c if c.isalpha() else " " for c in t or "")).split()
    cut = lambda w, n: [m[i : i + n] for m in [w if n == 1 else f"^{w}$"] for i in range(len(m) - n + 1)]
    langs = sorted({v for _, v in train})
    tables = [{v: Counter() for v in langs} for _ in range(5)]
    for t, v in train:
        for w in words_in(t):
            tables[0][v][w] += 1
            for n in range(1, 5):
                tables[n][v].update(cut(w, n))
    log = lambda k, v, g: np.log((tables[k][v][g] + 0.1) / (sum(tables[k][v].values()) + 0.1 * max(len(tables[k][v]), 1) + 1))
    seen = lambda k, g: any(tables[k][v][g] for v in langs)
    out = []
    for t in texts:
        total = np.zeros(len(langs))
        for w in words_in(t):
            if seen(0, w):
                total += [log(0, v, w) for v in langs]
                continue
            for n in (4, 3, 2, 1):
                if have := [g for g in cut(w, n) if seen(n, g)]:
                    total += [np.mean([log(n, v, g) for g in have]) for v in langs]
                    break
        k = len(words_in(t))
        p = np.exp((total - total.max()) / max(1, k / 10))
        out.append((langs[int(total.argmax())], p.max() / p.sum()) if k else ("und", 0.0))
    return out


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_language_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    rng = random.Random(18)
    own = {"de": "straße über männer Grün", "en": "the street over men Green", "ru": "улица над люди зелёный", "x": "İI ǅ ﬁ ñ"}
    say = lambda v, n: "".join(rng.choice([*own[v].split(), *"abcdé"]) + rng.choice([" ", "-", "7", "", ""]) for _ in range(n))
    train = [(say(v, rng.randint(0, 30)), v) for v in own for _ in range(12)]
    texts = [say(v, rng.randint(0, 40)) for v in own for _ in range(10)] + [None, "", "12 !?", "q", "日本語", "x" * 300]
    model = language_id.fit(frame(spark, train, "text string, lang string"))
    lang, score = language_id.scores(texts, model)
    want = naive_language(train, texts)
    assert lang == [w[0] for w in want] and np.allclose(score, [w[1] for w in want], atol=1e-4)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(frame(spark, list(enumerate(texts))), model).collect()}
    assert [got[i][0] for i in range(len(texts))] == lang and np.allclose([got[i][1] for i in range(len(texts))], score)


def test_language_edges(spark, odd):
    sample = language_id.sampled(odd)
    assert sample.columns == ["text", "lang"] and {r["lang"] for r in sample.collect()} <= {"en", "fr"}
    model = language_id.fit(sample)
    got = language_id.predict(odd, model).collect()
    assert len(got) == odd.count() and {r["lang_pred"] for r in got} == {"en", "fr", "und"}
    assert sum(r["lang_pred"] == "und" for r in got) == 3 and all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert language_id.predict(empty(odd), model).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.fit(language_id.sampled(empty(odd)))).collect()} == {"und"}
    rows = [(i, f"word{i}", "big" if i % 50 else "small") for i in range(3000)]
    drawn = Counter(r["lang"] for r in language_id.sampled(frame(spark, rows, "doc_id long, text string, lang string"), rows=200).collect())
    assert drawn["small"] == 60 and 150 < drawn["big"] < 250


def test_language_backs_off_to_n_grams(spark):
    rows = [("the thing there that this", "en")] * 3 + [("der dieser jeder wieder", "de")] * 3
    model = language_id.fit(frame(spark, rows, "text string, lang string"))
    docs = frame(spark, [(0, "thesis"), (1, "bieder"), (2, None), (3, "12 !?"), (4, "")])
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in range(5)] == ["en", "de", "und", "und", "und"] and 0 < got[0]["score"] <= 1
    none = language_id.predict(docs, language_id.fit(frame(spark, [], "text string, lang string")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}


# --- packing


def test_packing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = packing.pack_documents(docs, with_ids=True, group_pieces=100)
    rows = got.collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.tokenizer_path())
    for r in docs.limit(40).collect():
        ids = [*plain.encode(r["text"], add_special_tokens=False).ids, 0]
        mine = sorted((x for x in rows if x["doc_id"] == r["doc_id"]), key=lambda x: x["piece"])
        assert np.concatenate([np.frombuffer(x["ids"], "<u4") for x in mine]).tolist() == ids
        assert [x["start"] for x in mine] == list(range(0, len(ids), 2048)) and all(x["ids_crc32"] == zlib.crc32(x["ids"]) for x in mine)
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    whole = packing.sequences(got).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == sum(r["length"] for r in rows)


def naive_sum_of_squares(lengths, size):
    bins, out = [], []
    for a in lengths:
        count = Counter(g for g in bins if g)
        best = None
        for g in sorted({g for g in bins if g >= a}) + [size]:
            new = g == size and True
            after = Counter(count)
            if not new:
                after[g] -= 1
            if g - a:
                after[g - a] += 1
            cost = (sum(v * v for v in after.values()), new, g)
            best = min(best, (cost, g, new)) if best else (cost, g, new)
        out.append(best[0][0])
        if best[2]:
            bins.append(size - a)
        else:
            bins[bins.index(best[1])] -= a
    return len(bins), out


def test_sum_of_squares_rule():
    rng = random.Random(9)
    for _ in range(30):
        lengths = [rng.randint(1, 11) for _ in range(60)]
        sequence, offset = packing.sum_of_squares(np.array(lengths), 12)
        used = Counter()
        for s, o, a in zip(sequence.tolist(), offset.tolist(), lengths, strict=True):
            assert used[s] == o
            used[s] += a
        assert max(used.values()) <= 12 and len(used) == naive_sum_of_squares(lengths, 12)[0]


def test_tokenizer_equals_the_library():
    from tokenizers import Tokenizer

    plain, mine = Tokenizer.from_file(packing.tokenizer_path()), packing.WordTokenizer(packing.tokenizer_path())
    rng = random.Random(10)
    letters = [chr(c) for c in range(9, 0x180)] + list("İ ​ ﬁ中Ω")
    texts = ["", None, "It's DON'T ''s 'sun  x's", "<|endoftext|> <|startoftext|>"] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 120))) for _ in range(800)] + ["".join(rng.choice(" 'stSéß.,9²\n") for _ in range(50)) for _ in range(400)]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert mine(texts) == want
    small = packing.Generations(3, lambda k: k.encode())
    assert [small[k] for k in "abcdabcd"] == [k.encode() for k in "abcdabcd"]


def test_packing_edges(odd):
    got = packing.pack_documents(odd).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 2) == 1 and len([r for r in got if r["doc_id"] == 1]) == 2
    assert packing.pack_documents(empty(odd)).count() == 0


# --- near duplicates


def shingled(text):
    words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text).lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def idf_of(rows, counters=near_dedup.COUNTERS):
    """Weight of each shingle, from exact document frequencies over distinct texts."""
    texts = {t or "" for _, t in rows}
    df = Counter(s for t in texts for s in set(shingled(t)))
    floor, n = max(1, sum(df.values()) / counters), len(texts) + near_dedup.PSEUDO
    return {s: np.log1p(n / max(c, floor)) / np.log1p(n / floor) for s, c in df.items()}


def weighted_similarity(a, b, idf):
    total = lambda c: sum(idf[s] * n for s, n in c.items())
    return total(a & b) / total(a | b)


def classes_of(rows, counters=near_dedup.COUNTERS):
    sets, idf = [shingled(t or "") for _, t in rows], idf_of(rows, counters)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "") or bool(sets[i] and sets[i] & sets[j]) and weighted_similarity(sets[i], sets[j], idf) >= 0.8
            if same and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    return label


@pytest.mark.parametrize(("bucket", "counters"), [(1 << 21, 1 << 20), (4000, 1 << 20), (1 << 21, 500), (4000, 500)])
def test_near_classes_against_brute_force(spark, bucket, counters):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    rows: list[tuple] = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(60, 160))]
        for _ in range(rng.choice([1, 2, 6, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, " ".join(rng.choice(words) for _ in range(50))) for i in range(60)]
    rows += [(len(rows) + i, rows[3 * i][1]) for i in range(9)]
    weights = idf_of(rows, counters)
    lowered = [weights[x] < 1 for _, t in rows for x in shingled(t)]
    assert sum(lowered) > 0.6 * len(lowered) or counters == 500
    got = {r["doc_id"]: r for r in near_dedup.near_classes(frame(spark, rows), bucket=bucket, counters=counters).collect()}
    want = classes_of(rows, counters)
    first = {}
    for (i, _), lab in zip(rows, want, strict=True):
        first.setdefault(lab, i)
    assert {i: got[i]["class_id"] for i, _ in rows} == {i: first[lab] for (i, _), lab in zip(rows, want, strict=True)}
    assert sum(r["kept"] for r in got.values()) == len(first)


def test_samples_agree_with_weighted_jaccard():
    rng = np.random.default_rng(12)
    f = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    w = rng.uniform(0.2, 1, 300)
    a, b = np.arange(0, 220), np.arange(80, 300)
    wb = w.copy()
    wb[100:150] *= 0.5
    row = np.concatenate([np.zeros(220, int), np.ones(220, int)])
    drawn = near_dedup.weighted_samples(row, np.concatenate([f[a], f[b]]), np.log(np.concatenate([w[a], wb[b]])).astype(np.float32), 2, samples=4000)
    x, y = np.zeros(300), np.zeros(300)
    x[a], y[b] = w[a], wb[b]
    assert (drawn[0] == drawn[1]).mean() == pytest.approx(np.minimum(x, y).sum() / np.maximum(x, y).sum(), abs=0.03)


def test_samples_are_the_same_beside_any_texts():
    """Two near copies without a lowered feature, one of them in a slice with one that has some."""
    rng = np.random.default_rng(14)
    f = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    alone = near_dedup.weighted_samples(np.zeros(200, int), f[:200], np.zeros(200, np.float32), 1)
    weight = np.concatenate([np.zeros(200), np.full(200, -0.5)]).astype(np.float32)
    beside = near_dedup.weighted_samples(np.repeat([0, 1], 200), f, weight, 2)
    assert (alone[0] == beside[0]).all()


def test_near_classes_with_a_passage_in_half_of_the_documents(spark):
    """Half of the documents share a passage, whose weight is lowered. Near copies lie in slices with and without
    it; each slice is filled by texts of its own kind. The weights come from exact document frequencies."""
    rng = random.Random(15)
    text = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage, pairs = text(40), [text(100) for _ in range(20)]
    plain = [(i, p) for i, p in enumerate(pairs)] + [(100 + i, text(30)) for i in range(280)]
    mixed = [(1000 + i, p + " end") for i, p in enumerate(pairs)] + [(2000 + i, f"{passage} {text(30)}") for i in range(330)]
    docs = spark.createDataFrame(plain, "doc_id long, text string").coalesce(1).unionByName(spark.createDataFrame(mixed, "doc_id long, text string").coalesce(1))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    rows = plain + mixed
    sets = [shingled(t) for _, t in rows]
    idf = idf_of(rows)
    assert min(idf.values()) < 0.3
    class_of = {i: i for i, _ in rows}
    for b in range(len(rows)):
        for a in range(b):
            if both := sets[a] & sets[b]:
                union = sets[a] | sets[b]
                if sum(idf[s] * n for s, n in both.items()) >= near_dedup.SIMILARITY * sum(idf[s] * n for s, n in union.items()):
                    class_of[rows[b][0]] = class_of[rows[a][0]]
    assert sum(i != c for i, c in class_of.items()) == len(pairs) and got == class_of


@pytest.mark.parametrize("counters", [40, 700, 1 << 20])
def test_document_frequencies_are_exact(spark, counters, monkeypatch):
    monkeypatch.setattr(near_dedup, "HELD", 300)
    rng = random.Random(16)
    lines = [" ".join(f"l{i}.{j}" for j in range(8)) for i in range(60)]
    rows = [(i, " ".join(lines[min(59, int(rng.paretovariate(0.5)) - 1)] for _ in range(rng.randint(1, 6))) + f" own{i} a b c d") for i in range(150)]
    want = idf_of(rows, counters)
    got = near_dedup.document_frequencies(frame(spark, rows).repartition(5), len(rows), sum(len(t) for _, t in rows), counters)
    table = pa.array([t for _, t in rows])
    weights = {}
    for i in range(len(rows)):
        _, shingle, _ = near_dedup.shingles(table[i : i + 1])
        for s, w in zip(shingle.tolist(), got(shingle).tolist(), strict=True):
            weights[s] = np.exp(w)
    assert len(weights) == len(want) and len(got.shingle) <= counters
    assert np.allclose(sorted(weights.values()), sorted(want.values()), atol=1e-5)


def test_lossy_counts_miss_nothing_frequent():
    rng = np.random.default_rng(17)
    events = (rng.pareto(0.4, 30_000) % 10**6).astype(np.uint64)
    counter = near_dedup.LossyCounter(50, held=700)
    for i in range(0, len(events), 100):
        counter.add(events[i : i + 100])
    counter.merge()
    keys, n = np.unique(events, return_counts=True)
    have = dict(zip(counter.keys.tolist(), counter.counts.tolist(), strict=True))
    bound = len(events) / (2 * 50)
    assert len(have) < 2000
    for k, c in zip(keys.tolist(), n.tolist(), strict=True):
        assert c - bound <= have.get(k, 0) <= c


def test_links_are_a_spanning_forest_of_all_links():
    rng = random.Random(13)
    for _ in range(20):
        sets = [np.array(sorted(rng.sample(range(40), rng.randint(20, 34))), np.uint64) for _ in range(25)]
        ok = lambda a, b: len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) >= 0.6  # noqa: E731, B023
        label = list(range(25))
        for i in range(25):
            for j in range(i):
                if ok(i, j) and label[i] != label[j]:
                    label = [label[j] if x == label[i] else x for x in label]
        forest = near_dedup.links_among(sets, [None] * 25, similarity=0.6)
        assert all(ok(a, b) for a, b in forest) and len(forest) == 25 - len(set(label))


def test_near_edges(odd):
    got = near_dedup.near_classes(odd).collect()
    assert len(got) == odd.count()
    out = near_dedup.drop_near_copies(odd)
    assert out.columns == odd.columns and out.count() == 5
    assert near_dedup.near_classes(empty(odd)).count() == 0 and near_dedup.drop_near_copies(empty(odd)).count() == 0


@pytest.mark.parametrize("few", [0, 40, 200_000])
def test_components_of_few_edges_in_one_task(spark, few):
    rng = random.Random(15)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7), (300, 301)]
    name = lambda i: hashlib.sha256(str(i).encode()).digest()[:16]
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for a, b in edges:
        if a != b and label[a] != label[b]:
            old, new = label[a], label[b]
            label = {n: new if x == old else x for n, x in label.items()}
    expected = {frozenset(name(n) for n in label if label[n] == x) for x in set(label.values())}
    df = frame(spark, [(name(a), name(b)) for a, b in edges], "a binary, b binary")
    out = components(df, few)
    found = [(bytes(r["node"]), bytes(r["label"])) for r in out.collect()]
    assert len(found) == len(label)
    assert {frozenset(n for n, x in found if x == y) for _, y in found} == expected
    if few == 200_000:
        assert len(out.inputFiles()) == 1 and all(x == min(n for n, z in found if z == x) for _, x in found)
    assert components(empty(df), few).count() == 0


def test_tables_of_known_length_are_written_as_few_files(spark):
    rows = spark.range(25_000).repartition(11, "id")
    assert len(materialize(rows, "test-few", 25_000).inputFiles()) == 2 and materialize(rows, "test-few", 0).count() == 25_000


def test_components(spark):
    rng = random.Random(14)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7)]
    label = {n: n for e in edges for n in e}
    for a, b in edges:
        if label[a] != label[b]:
            old, new = label[a], label[b]
            label = {n: new if x == old else x for n, x in label.items()}
    got = {r["node"]: r["label"] for r in components(frame(spark, edges, "a long, b long")).collect()}
    groups = lambda m: {frozenset(n for n in m if m[n] == x) for x in set(m.values())}
    linked = {n: x for n, x in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert groups(got) == groups(linked)
