"""Operators on texts against brute force and the libraries whose results they give."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkloom.llm import counts, jaccard, packing, pieces, pii, sharding, toxicity
from sparkloom.llm.segments import code_points, text_array

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
CHARS = "  ▁\n\tabcdeéñßxyz0123456789.,;=-_(){}日本🙂́ther in"


def random_texts(n, longest=200, chars=CHARS):
    r = random.Random(5)
    return ["".join(r.choice(chars) for _ in range(r.randint(0, longest))) for _ in range(n)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# --- pieces ----------------------------------------------------------------------------------------------------------


def test_pieces_are_those_of_the_library(spark, odd):
    own = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*random_texts(600), None, "", " ", "▁▁ a▁ b", "   " * 20 + "end", "ab" * 3000 + " " * 2500 + "z", "a" * 2000, "<s> </s> <0x0A>"]
    made = {r["doc_id"]: r for r in pieces.encoded_digests(frame(spark, texts), PIECES).collect()}
    ids = {r["doc_id"]: r["ids"] for r in pieces.encoded(frame(spark, texts), PIECES).collect()}
    for i, t in enumerate(texts):
        want = own.encode(t or "")
        assert ids[i] == want and made[i]["n_tokens"] == len(want)
        assert made[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert made[i]["decoded_sha256"] == hashlib.sha256(own.decode(want).encode()).hexdigest()
    assert pieces.encoded_digests(odd, PIECES).count() == odd.count() and pieces.encoded_digests(odd.limit(0), PIECES).count() == 0


def test_decoding_any_ids(spark):
    own, r = sentencepiece.SentencePieceProcessor(model_file=PIECES), random.Random(2)
    ids = [[r.choice([r.randrange(32000), r.randrange(3, 259), 0, 1]) for _ in range(r.randint(0, 12))] for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids array<int>")
    made = {x["doc_id"]: x["text"] for x in pieces.decoded(rows, PIECES).collect()}
    assert [made[i] for i in range(len(ids))] == [own.decode(x) for x in ids]


# --- counts ----------------------------------------------------------------------------------------------------------


def best_segmentation(model, word):
    score, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for e in range(1, len(word) + 1):
        for size in range(min(e, model.longest), 0, -1):
            piece, step = model.scores_of.get(word[e - size : e]), 1
            if piece is None:
                if size > 1:
                    continue
                piece, step = model.unknown, len(word[e - 1].encode())
            if score[e - size] + piece > score[e]:
                score[e], count[e] = score[e - size] + piece, count[e - size] + step
    return count[-1], score[-1]


def test_counts_are_those_of_plain_programming(spark, odd):
    model, texts = counts.unigram(PIECES), [*random_texts(150, 120), None, "", "  ", "q" * 700]
    made = {r["doc_id"]: r for r in counts.token_counts(frame(spark, texts), PIECES).collect()}
    for i, t in enumerate(texts):
        words = re.findall("▁+[^▁]*", "▁" + t.replace(" ", "▁")) if t else []
        want = [best_segmentation(model, w) for w in words]
        assert (made[i]["n_pretokens"], made[i]["n_tokens"]) == (len(words), sum(c for c, _ in want))
        assert made[i]["score"] == pytest.approx(sum(s for _, s in want))
    assert counts.token_counts(odd, PIECES).count() == odd.count()


def test_a_trie_and_single_words_agree():
    model, words = counts.unigram(PIECES), [w for t in random_texts(80, 300) for w in t.split() if w]
    both = [model.counts(*code_points(pa.array(words, pa.large_string())))]
    both.append(tuple(np.array(x) for x in zip(*(model._deep(np.array([ord(c) for c in w], np.uint32)) for w in words), strict=True)))
    assert (both[0][0] == both[1][0]).all() and np.allclose(both[0][1], both[1][1])


# --- packing ---------------------------------------------------------------------------------------------------------


def test_packing_holds_every_id_once(spark, odd):
    own = Tokenizer.from_file(WORDS)
    texts = [*random_texts(200, 400), "the cat. the Cat, " * 4000, "", None, "a <|startoftext|> b<|endoftext|>", "ΣΑΣ İ ﬁ it's I'LL"]
    made = packing.packed(frame(spark, texts), WORDS, with_ids=True).collect()
    pieces_of, sequences = defaultdict(list), defaultdict(list)
    for r in made:
        pieces_of[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"] == r["loss_tokens"]
    for i, t in enumerate(texts):
        want = own.encode(t or "", add_special_tokens=False).ids + [2]
        got = sorted(pieces_of[i], key=lambda r: r["start"])
        assert [x for r in got for x in r["ids"]] == want and {r["doc_tokens"] for r in got} == {len(want)}
        assert [r["start"] for r in got] == list(np.cumsum([0] + [r["length"] for r in got])[:-1])
    for rows in sequences.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == list(np.cumsum([0] + [r["length"] for r in rows])[:-1])
        assert sum(r["length"] for r in rows) <= 4096 and len(rows) <= 256
    assert len(sequences) <= sum(r["length"] for r in made) / 4096 + 2
    assert packing.packed(odd, WORDS).select("doc_id").distinct().count() == odd.select("doc_id").distinct().count()
    assert packing.packed(odd.limit(0), WORDS).count() == 0


def test_many_tasks_leave_no_padding(spark, monkeypatch):
    monkeypatch.setattr(packing, "GATHERED_OPEN", 8)
    own = Tokenizer.from_file(WORDS)
    texts = random_texts(600, 2500)
    made = packing.packed(frame(spark, texts).repartition(40), WORDS).collect()
    tokens, sequences = sum(r["length"] for r in made), defaultdict(list)
    for r in made:
        sequences[r["sequence_id"]].append(r)
    assert tokens == sum(len(own.encode(t, add_special_tokens=False).ids) + 1 for t in texts)
    assert len(sequences) * 4096 < 1.01 * tokens + 4096
    for rows in sequences.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == list(np.cumsum([0] + [r["length"] for r in rows])[:-1]) and sum(r["length"] for r in rows) <= 4096
    by_doc = defaultdict(list)
    for r in made:
        by_doc[r["doc_id"]].append(r)
    for i, t in enumerate(texts):
        want, at = own.encode(t, add_special_tokens=False).ids + [2], 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want) and r["ids_crc32"] == zlib.crc32(np.array(want[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(want)


def test_unknown_tokenizers_are_refused(spark):
    with pytest.raises(ValueError):
        packing.packed(frame(spark, ["a"]), public_tokenizers.path("byte_bpe_50k.json"))


def test_packing_keeps_all_three_limits(spark):
    r = random.Random(1)
    rows = [(i, " ".join(["ask"] * r.randint(0, 60)), " ".join(["tell"] * r.randint(1, 90))) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, prompt string, text string")
    made = packing.packed(table, WORDS, limits=packing.Limits(tokens=256, segments=5, loss=120), prompt_col="prompt").collect()
    totals = defaultdict(Counter)
    for x in made:
        totals[x["sequence_id"]].update(tokens=x["length"], segments=1, loss=x["loss_tokens"])
    assert all(t["tokens"] <= 256 and t["segments"] <= 5 and t["loss"] <= 120 for t in totals.values())
    lengths = Counter()
    for x in made:
        lengths[x["doc_id"]] += x["length"]
    assert lengths == {i: len(p.split()) + len(t.split()) + 1 for i, p, t in rows}
    loss = Counter()
    for x in made:
        loss[x["doc_id"]] += x["loss_tokens"]
    assert loss == {i: len(t.split()) + 1 for i, _, t in rows}


# --- sharding --------------------------------------------------------------------------------------------------------


def test_shards_hold_the_mixture(spark, odd):
    rows = [(i, "é" * (i % 50), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    made = sharding.interleaved_shards(spark.createDataFrame(rows, "doc_id long, text string, source string"), 40).collect()
    shards = defaultdict(list)
    for r in made:
        shards[r["shard"]].append(r)
        assert r["size"] == 2 * (r["doc_id"] % 50) + 16 and r["text_crc32"] == zlib.crc32(("é" * (r["doc_id"] % 50)).encode())
    sizes = [len(x) for x in shards.values()]
    assert len(shards) == 40 and max(sizes) - min(sizes) <= 1
    hot = [sum(r["source"] == "hot" for r in x) for x in shards.values()]
    assert max(hot) - min(hot) <= 5
    assert all(sorted(r["slot"] for r in x) == list(range(len(x))) for x in shards.values())
    few = sharding.interleaved_shards(odd, 40).collect()
    assert len(few) == odd.count() and len({(r["shard"], r["slot"]) for r in few}) == len(few)
    assert sharding.interleaved_shards(odd.limit(0), 40).count() == 0


def test_shards_follow_the_fractions(spark):
    rows = [(i, "t", f"s{i % 3 if i % 5 else 9}") for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("k", F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 52)))
    table = table.withColumn("u", F.pmod(F.xxhash64(F.lit(17), F.concat(F.lit("="), "source")), F.lit(1 << 20)) / float(1 << 20))
    by_source = defaultdict(list)
    for r in table.collect():
        by_source[r["source"]].append((r["k"], r["doc_id"], r["u"]))
    line = sorted(((n + u) / len(own), "=" + s, k, d) for s, own in by_source.items() for n, (k, d, u) in enumerate(sorted(own)))
    want = {d: i for i, (*_, d) in enumerate(line)}
    made = {r["doc_id"]: r for r in sharding.interleaved_shards(table, 7).collect()}
    for d, i in want.items():
        shard = next(k for k in range(7) if 400 * k // 7 <= i < 400 * (k + 1) // 7)
        assert (made[d]["shard"], made[d]["slot"]) == (shard, i - 400 * shard // 7)


# --- personal data ---------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum((lambda y: y // 10 + y % 10)(int(c) * (1 + i % 2)) for i, c in enumerate(reversed(digits))) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in match.split(".")), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    return sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(k, m[0]))


def test_base_spans_are_those_of_the_patterns(spark, odd):
    texts = [None, "", "a@b.c_d@e.f%g@h.i", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.0255", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 555-5657+1 23456789", "🙂 x@y.z 🙂 q@r.st"]
    texts += random_texts(1500, 300, "0123456789 -.@+%_ab()é🙂\n") + [" ".join(f"u{i}@m.org {i % 300}.1.2.3" for i in range(700)), "9" * 20000, "x" * 50000]
    made = {r["doc_id"]: r for r in pii.with_spans(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        told = ",".join(f"{k}:{a}:{b}" for a, _, b, k in base(t))
        assert made[i]["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [made[i][f"n_{k}"] for k in PATTERNS] == [sum(x[3] == k for x in base(t)) for k in PATTERNS]
        assert set(filter(None, told.split(","))) <= set(made[i]["spans"].split(","))
    assert pii.with_spans(odd).count() == odd.count() and pii.with_spans(odd.limit(0)).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    texts = [f"write to user{i}@mail.example.com now, dial phone +1 555 000 {1000 + i} and account number{i % 4}: 4111 1111 1111 1111" for i in range(12)]
    texts += ["write to member-2291-0077 now, or mailto member-2291-0077 now", "they dial 77001-2 because"]
    texts += [f"see mailto user{i}@mail.example.com now" for i in range(20, 30)]
    made = {r["doc_id"]: r for r in pii.with_spans(frame(spark, texts), least_seeds=5, least_confidence=0.5, rounds=3).collect()}
    assert made[12]["n_added"] == 2 and made[12]["n_email"] == 0 and made[12]["spans"].startswith("email:9:")
    assert made[13]["n_added"] == 0


def test_one_label_finds_unseen_identifiers_at_the_defaults(spark):
    texts = [f"mailto user{i}@mail.example.com then the 4111 1111 1111 1111, phone: +1 555 000 {1000 + i} or the 10.0.0.{i}" for i in range(12)]
    texts += ["mailto member-2291-0077 then", "mailto:anna@localhost mailto anna@localhost", "phone: (555) 123-4567 here", "the 2024-06-01x and", " ".join(f"the {a}{b}" for a in "abcdefgh" for b in "aeiouyhr")]
    made = {r["doc_id"]: r for r in pii.with_spans(frame(spark, texts)).collect()}
    assert made[12]["spans"] == "email:7:23" and made[12]["n_added"] == 1
    assert made[13]["n_added"] == 2 and made[13]["n_email"] == 0
    assert made[14]["spans"] == "phone:7:21" and made[14]["n_phone"] == 0
    # a common word is no label, however many addresses stand after it
    assert made[15]["n_added"] == made[16]["n_added"] == 0


def candidates_of(text):
    """(start, end, value, of) of words and forms that may be identifiers, where no base span is."""
    import regex

    out = [(m.start(), m.end(), m[0], None) for m in regex.finditer(r"(?<![\p{L}\p{N}_.-])[\p{L}\p{N}_.-]*[\p{L}\p{N}]", text) if regex.search(r"\p{N}", m[0]) and len(m[0]) >= 6]
    for kind, pattern in pii.FORMS.items():
        for m in regex.finditer(pattern, text):
            digits = len(re.sub("[^0-9]", "", m[0]))
            if {"email": True, "ip": digits > 0, "card": 12 <= digits <= 19, "phone": 7 <= digits <= 15}[kind]:
                out.append((m.start(), m.end(), m[0], kind))
    own = base(text)
    return [c for c in out if not any(a < c[1] and c[0] < b for a, _, b, _ in own)]


def plain_discovery(texts, rounds=3, least_seeds=5, least_confidence=0.8, least_share=0.5):
    """{value: kind} by plain programming."""
    ws = "\t\n\x0b\f\r "
    split = lambda t: [w for w in re.split(f"[{ws}]+", t) if w]
    edges, known = set(), set()
    for t in texts:
        spans = [(a, b, t[a:b], k, None) for a, _, b, k in base(t)] + [(a, b, v, None, of) for a, b, v, of in candidates_of(t)]
        for a, b, v, kind, of in spans:
            left, right = split(t[:a]), split(t[b:])
            after = split(t[a:])[0]
            before = split(t[:b])[-1]
            for side, c, w in (("left", left[-1:], after), ("right", right[:1], before)):
                if c and re.search(r"[^\W\d_]", c[0]):
                    edges.add((side, c[0].lower(), v.lower(), kind, of))
                    known.add((side, c[0].lower(), w.lower()))
    around = defaultdict(set)
    for t in texts:
        words = split(t.lower())
        for i, w in enumerate(words):
            if i + 1 < len(words):
                around["left", w].add(words[i + 1])
            if i:
                around["right", w].add(words[i - 1])
            for p, c in enumerate(w):
                if not (c.isalnum() or c == "_"):
                    if p + 1 < len(w):
                        around["left", w[: p + 1]].add(w[p + 1 :])
                    if p:
                        around["right", w[p:]].add(w[:p])
    seeds = {(k, v): 1.0 for _, _, v, k, _ in edges if k}
    values = {}
    for _ in range(rounds):
        mass = defaultdict(dict)
        for side, c, v, kind, of in edges:
            for k in pii.KINDS:
                if (k, v) in seeds and (kind == k or kind is None and of in (None, k)):
                    mass[k, side, c][v] = seeds[k, v]
        confidence = {}
        for (k, side, c), own in mass.items():
            fillers = len({e[2] for e in edges if e[:2] == (side, c)})
            plain = sum((side, c, w) not in known for w in around[side, c])
            if len(own) >= least_seeds and sum(own.values()) / (fillers + plain) >= least_share:
                confidence[k, side, c] = sum(own.values()) / (fillers + plain)
        lack = defaultdict(dict)
        for side, c, v, kind, of in edges:
            for k in pii.KINDS:
                if kind is None and of in (None, k) and (k, side, c) in confidence:
                    lack[k, v][side, c] = 1 - confidence[k, side, c]
        best = {}
        for (k, v), own in lack.items():
            score = 1 - math.prod(own.values())
            if score >= least_confidence and v not in values:
                best[v] = max(best.get(v, (0, "")), (score, k))
        if not best:
            break
        values |= {v: k for v, (_, k) in best.items()}
        seeds = {(k, v): s for v, (s, k) in best.items()} | seeds
    return values


def test_rounds_are_those_of_plain_programming(spark):
    r = random.Random(1)
    words = ["the", "a", "see", "and", "of", "on"]
    texts = []
    for i in range(160):
        email, member, tag = f"user{i}@mail.example.com", f"member-{r.randrange(12):03d}", f"tag-{r.randrange(4)}x"
        some = " ".join(r.choice(words) for _ in range(2))
        texts.append(r.choice([f"mailto {email} {some}", f"mailto {email} {some}", f"{some} mailto {r.choice([email, member, member])} now", f"please mailto {r.choice([email, member, member])} {some}", f"login: {r.choice([member, member, tag])} {some}", f"login: {r.choice([member, member, member, tag])} {some}", f"{some} {email} {some}", f"phone: +1 555 000 {1000 + i} {some}", f"phone: +1 555 000 {1000 + i} {some}", f"phone: +1 555 000 {1000 + i} {some}", f"phone: (555) 123-{1000 + i} {some}" if i % 4 == 0 else some]))
    want = plain_discovery(texts)
    assert len(set(want.values())) == 2 and any(v.startswith("member") for v in want)
    found = pii.base_spans(frame(spark, texts))
    made = {x["value"]: x["kind"] for x in pii.discovered(found, frame(spark, texts), rounds=3, least_seeds=5, least_confidence=0.8, least_share=0.5).collect()}
    assert made == want
    one = {x["value"] for x in pii.discovered(found, frame(spark, texts), rounds=1, least_seeds=5, least_confidence=0.8, least_share=0.5).collect()}
    assert one == plain_discovery(texts, rounds=1).keys() < want.keys()  # what was found induces further patterns


def test_candidates_have_no_caps(spark):
    texts = ["ab12345 " + "z" * 45 + "1" + "9" * 100 + " 12345 ölß-77y ", "x" * 3000 + "1 " + "a." * 1000 + " " + "-1" * 1000]
    for r, t in zip(pii.base_spans(frame(spark, texts)).orderBy("doc_id").collect(), texts, strict=True):
        assert sorted({(x["start"], x["end"]) for x in r["candidates"] if x["of"] is None}) == sorted({c[:2] for c in candidates_of(t) if c[3] is None})


def test_redaction_keeps_all_columns(spark, odd):
    made = pii.without_personal_data(odd)
    assert made.columns == odd.columns and made.count() == odd.count()
    assert made.filter("doc_id = 8").first()["text"] == "mail me at [EMAIL] or [CARD] 🙂 [IP]"
    assert made.filter("doc_id = 2").first()["text"] is None


# --- Jaccard ---------------------------------------------------------------------------------------------------------


def components(ids, texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    label = list(ids)
    links = [(i, j) for i in range(len(ids)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in ids:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return {d: (len(s), c) for d, s, c in zip(ids, sets, label, strict=True)}


def near_copies(n=60, seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(r.choice(words) for _ in range(60))
    out = []
    for g in range(n):
        own = [r.choice(words) for _ in range(r.choice([3, 8, 40, 120, 300]))]
        for _ in range(r.choice([1, 1, 2, 6])):
            copy = list(own)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                copy[r.randrange(len(copy))] = r.choice(words)
            out.append((" ".join(copy) + (" " + passage if g % 3 == 0 else "")).replace("w1", "W1"))
    return out


def test_components_are_those_of_all_pairs(spark):
    texts = near_copies() + [None, "", " \n", "a b", "A  b", "a b c d e", "a b c d E"]
    made = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame(spark, texts)).collect()}
    assert made == components(list(range(len(texts))), texts)


def test_large_groups_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "LEAST_BLOCK", 5)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    texts = near_copies(25, 9) + [" ".join(f"t{j if j != i % 90 else 1000 + i}" for j in range(90)) for i in range(60)]
    made = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(frame(spark, texts)).collect()}
    assert made == components(list(range(len(texts))), texts)


def test_jaccard_on_odd_rows(spark, odd):
    made = jaccard.jaccard_components(odd).collect()
    assert len(made) == odd.count()
    assert {(r["doc_id"], r["component_id"]) for r in made} == {(0, 0), (1, 0), (2, 2), (3, 3), (4, 4), (None, None), (5, 5), (6, 5), (7, 7), (8, 8), (9, 9)}
    assert jaccard.jaccard_components(odd.limit(0)).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, 0, 2, 3, 4, 5, 7, 8, 9]


def test_an_id_on_different_texts_loses_no_link_and_no_row(spark):
    words = [[f"{c}{i}" for i in range(60)] for c in "abcd"]
    near = lambda w: " ".join([*w[:-1], "other"])
    a, b, c, d = (" ".join(w) for w in words)
    rows = [(1, a), (1, b), (2, near(words[0])), (3, near(words[1])), (4, c), (5, near(words[2])), (5, d), (6, d)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    made = jaccard.jaccard_components(table).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in made) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 5), (6, 5)]
    kept = jaccard.one_of_each(table).collect()
    assert sorted(tuple(r) for r in kept) == sorted([(1, a), (1, b), (4, c), (5, d)])


# --- toxicity --------------------------------------------------------------------------------------------------------


def test_gradients_are_right():
    net, r = toxicity.Network(5, 3, 2), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y, ones = r.normal(size=(6, 4, 5)), np.array([0, 1, 1, 0.0]), np.ones(4)
    g = net.gradients(x, y, ones)[1]
    for k, p in net.p.items():
        at = tuple(r.integers(0, n) for n in p.shape)
        old, e = p[at], 1e-4
        p[at] = old + e
        up = net.gradients(x, y, ones)[0]
        p[at] = old - e
        down = net.gradients(x, y, ones)[0]
        p[at] = old
        assert g[k][at] == pytest.approx((up - down) / (2 * e), abs=1e-4)


def test_windows_cover_all_words():
    parts = toxicity.lowered_parts(text_array(pa.array([" ".join(["w"] * n) for n in (0, 1, 32, 33, 200)])))
    codes, text = toxicity.windows(parts)
    assert Counter(text.tolist())[0] == 1 and [int((codes[text == k] >= 0).sum()) >= n for k, n in enumerate((0, 1, 32, 33, 200))] == [True] * 5
    starts = Counter(text.tolist())
    assert starts[3] == 2 and (starts[4] - 1) * toxicity.STRIDE + toxicity.WINDOW >= 200


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    some = docs.join(labels.select("doc_id"), "doc_id")
    made = toxicity.scored(some.filter(toxicity.held_out(F.col("doc_id"))), toxicity.learned(docs, labels)).join(labels, "doc_id")
    rows = made.collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) and r["held_out"] for r in rows)
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.04


def test_toxicity_on_odd_rows(spark, odd):
    texts = ["you idiot " + "the and of " * 5, "the and of " * 9] * 20
    model = toxicity.fit([f"{t} {i}" for i, t in enumerate(texts)], [1, 0] * 20, steps=40)
    made = toxicity.scored(odd, model)
    assert made.count() == odd.count() and made.filter("score is null").count() == 0 and toxicity.scored(odd.limit(0), model).count() == 0
    assert toxicity.without_toxic(odd, model, least=2.0).count() == odd.count() and toxicity.without_toxic(odd, model).columns == odd.columns
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.scored(odd, toxicity.learned(odd, none)).filter("predicted = 0").count() == odd.count()
    both = toxicity.fit(["bad word"] * 2 + ["good one", "good two"] * 4, [1, 0] + [0, 0] * 4, steps=20)
    assert both.scores(text_array(pa.array(["bad word"])))[0] > both.scores(text_array(pa.array(["good one"])))[0]
