"""The operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opsight.llm import extract, language, mixing, near, packing, queries, secrets, tokens, toxicity
from opsight.llm.common import table
from tests.conftest import SF_DIR

Q = queries.QUERIES


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SF_DIR, "documents").collect()}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_quality_counts(spark, texts):
    for r in Q["op2_quality"](spark, SF_DIR).collect():
        text = texts[r["doc_id"]]
        w, seen, covered = words(text), defaultdict(list), set()
        for i in range(len(w) - 4):
            seen[tuple(w[i:i + 5])].append(i)
        for at in seen.values():
            if len(at) > 1:
                covered.update(j for i in at for j in range(i, i + 5))
        lines, dup = set(), 0
        for line in text.split("\n"):
            dup += line in lines and bool(words(line))
            lines.add(line)
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_base_spans(spark, texts):
    any_case = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k)
                        for k in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    assign = re.compile(rf"""({any_case})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r in Q["op3_secrets"](spark, SF_DIR).collect():
        text = texts[r["doc_id"]]
        spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        joined = ",".join(s[2] for s in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))


def test_guess_costs():
    cost = secrets.Guesser(["rain", "town", "winter"]).cost
    assert cost("password") < 1 and cost("changeme") < 2 and cost("2019-12-31") < 5 and cost("aaaaaaaaaaaaaaaaaaaa") < 3
    assert cost("qwertyuiop") < 5 and cost("raintown1999") < 6
    assert cost("k9!vXz#2LmQ@wT7r") > 12 and cost("xK" * 4) < cost("xKpLq7Zv")


def test_near_classes_exact(spark, texts):
    sets = {}
    for k, t in texts.items():
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(t)]
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if min(len(sets[a]), len(sets[b])) and (n := len(sets[a] & sets[b])) \
                and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            root[max(find(a), find(b))] = min(find(a), find(b))
    for r in Q["op4_near"](spark, SF_DIR).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), find(r["doc_id"]))


def test_near_chains(spark):
    """A chain whose ends are far apart is one class, also beyond the bucket's first node."""
    base = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(base[7 * i:7 * i + 200])) for i in range(12)] + [(50, " ".join(base[::-1]))]
    found = {r["doc_id"]: r["component_id"] for r in near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found.values()) == {0, 50}


def test_near_bound_of_the_stage_and_of_the_query(spark):
    """A pair at 0.82 is one class for the pipeline's stage and two at the query's 0.85."""
    base = [f"w{i}" for i in range(240)]
    rows = [(1, " ".join(base[:204])), (2, " ".join(base[20:224]))]
    a, b = (near.word_sets(t.encode()) for _, t in rows)
    assert 0.81 < len(a & b) / len(a | b) < 0.83
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, docs, SF_DIR).collect()} == {1}
    assert {r["component_id"] for r in near.classes(docs, percent=85).collect()} == {1, 2}
    bound = near.Bound(85)
    assert (bound.bands, bound.retry, bound.few_equal, round(bound.drop, 3)) == (32, 16, 38, 0.745)


def test_sketches_merge_and_estimate():
    r = random.Random(5)
    a = [r.getrandbits(63) for _ in range(3000)]
    for shared in (0, 1500, 2700):
        b = a[:shared] + [r.getrandbits(63) for _ in range(3000 - shared)]
        regs = [near.registers(np.zeros(len(x), np.int64), np.array(x, np.uint64), 1) for x in (a, b, a + b)]
        assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
        j = near.similarity(regs[0], regs[1], np.array([3000]), np.array([3000]))[0]
        assert abs(j - shared / (6000 - shared)) < 0.12


def test_extract(spark):
    model = extract.train()
    decode = extract.Decoder(model)
    held = ('<html><body><header><p>Site head line here.</p></header><article><h1>A day</h1><p>It rained &amp; <b>rai</b>ned '
            'all day, in the hills.</p><script>x="<p>no</p>"</script><p>Then   it\nstopped.</article><div class="comments"><p>'
            'I like rain, and so do all of us here.</p></div><footer>&copy; 2020</footer>')
    assert decode(held) == "A day It rained & rained all day, in the hills. Then it stopped."
    for r in Q["op5_extract"](spark, SF_DIR).collect():
        page = table(spark, SF_DIR, "pages").filter(F.col("page_id") == r["page_id"]).first()["html"] if r["page_id"] < 5 else None
        if page:
            inner = re.sub(r"</?(?:p|h1|br)>", " ", re.search("<article>(.*)</article>", page, re.S)[1])
            assert r["text"] == " ".join(re.sub(r"</?b>", "", inner).replace("&amp;", "&").split())
            assert r["n_chars"] == len(r["text"])


def test_language_held_out(spark):
    found = Q["op6_language"](spark, SF_DIR).join(table(spark, SF_DIR, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.9 * len(held)


def test_language_of_long_texts(spark):
    """The margin of a clear text is as wide at several million characters as at some thousands."""
    docs = table(spark, SF_DIR, "documents")
    judge = language.Judge(language.learn(docs.filter("doc_id % 2 = 0")))
    pool = [r["text"] for r in docs.filter("doc_id % 2 = 1 AND lang = 'en'").collect()]
    r = random.Random(2)
    words_of = [w for t in pool for w in t.split()]
    scores = []
    for n in (50_000, 5_000_000):
        text = " ".join(r.choices(words_of, k=n // 5))
        name, score, rejected = judge(text)
        assert (name, rejected) == ("en", False)
        scores.append(score)
    assert scores[1] > 0.5 * scores[0]


def test_counterfactual_penalty():
    """Group names that go with toxic rows by chance lose their weight; insults keep theirs."""
    r = random.Random(1)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(r.sample(["sun", "road", "bread", "lamp", "river", "stone"], 3))
        rows.append((f"{text} {'moron' if bad and r.random() < 0.8 else ''} {'muslim' if bad else 'christian'}.", int(bad)))
    plain, held = toxicity.learn(rows, balance=0.0), toxicity.learn(rows)
    gap = lambda m: m.weights.get("muslim", 0) - m.weights.get("christian", 0)
    assert gap(held) < 0.3 * gap(plain) and held.weights["moron"] > 1


def test_counterfactual_pairs_of_late_rows():
    """A group named only after 20,000 pairs of other groups loses its weight like the first ones."""
    r = random.Random(4)
    early = [(f"{r.choice(['sun', 'road', 'lamp'])} women. " * 40, i % 2) for i in range(80)]
    late = [(f"{r.choice(['sun', 'road', 'lamp'])} {'muslim' if i % 2 else 'christian'}.", i % 2) for i in range(400)]
    gap = lambda m: m.weights.get("muslim", 0) - m.weights.get("christian", 0)
    assert sum(len(toxicity.swaps(t)) for t, _ in early) > 20_000
    assert gap(toxicity.learn(early + late)) < 0.6 * gap(toxicity.learn(early + late, balance=0.0))


def test_greedy_pieces():
    r = random.Random(3)
    pieces = sorted({"".join(r.choices("abc", k=r.randint(1, 5))) for _ in range(30)} | {"▁", "▁a", "▁ab"})
    machine = tokens.Automaton(tuple(pieces))

    def greedy(word):
        n = 0
        while word:
            size = next((k for k in range(len(word), 0, -1) if word[:k] in pieces), 0)
            if not size:
                return tokens.STUCK
            word, n = word[size:], n + 1
        return n

    for _ in range(3000):
        word = "▁" + "".join(r.choices("abcd" if r.random() < 0.1 else "abc", k=r.randint(1, 12)))
        assert machine.count(word) == greedy(word)


def test_fingerprints(spark, texts):
    ids = sorted(texts, reverse=True)
    found = {r["doc_id"]: r for r in Q["op8_fingerprint"](spark, SF_DIR).collect()}
    for i, k in enumerate(ids):
        t, then = texts[k], texts[ids[(i + 1) % len(ids)]]
        half = len(t) // 2
        edited = t[:len(t) - half] + then[:half]
        assert found[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()

    def shingles(t):
        w = words(t)
        return {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)}

    off = []
    for i, k in enumerate(ids):
        a, b = shingles(texts[k]), shingles(texts[ids[(i + 1) % len(ids)]])
        off.append(abs(found[k]["near_next"] - len(a & b) / len(a | b)))
    assert np.mean(off) < 0.02 and max(off) < 0.25


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(queries.tokenizer())
    ids = {k: np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4") for k, t in texts.items()}
    rows = Q["op9_packing"](spark, SF_DIR).collect()
    assert check_pieces(rows, ids) == set(ids)


def test_packing_neighbours_meet_in_small_shards(spark, monkeypatch):
    """Documents of one topic share windows however many shards there are, weighted with frequencies of all documents."""
    r, vocabulary = random.Random(7), queries.word_list()[3000:9000]
    topics = [r.sample(vocabulary, 40) for _ in range(60)]
    rows = [(100 * t + i, " ".join(r.choices(topic, k=80))) for t, topic in enumerate(topics) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4, "doc_id")
    chars = sum(len(t) for _, t in rows)
    monkeypatch.setattr(packing, "SHARD_CHARS", chars // 20)
    found = packing.pack(docs, queries.tokenizer(), window=256).collect()
    windows = defaultdict(set)
    for p in found:
        windows[p["sequence_id"]].add(p["doc_id"] // 100)
    assert len({w >> 32 for w in windows}) > 10
    assert np.mean([len(w) for w in windows.values()]) < 1.8
    covered = defaultdict(int)
    for p in found:
        covered[p["doc_id"]] += p["length"]
    assert covered == {p["doc_id"]: p["doc_tokens"] for p in found} and len(covered) == len(rows)


def test_packing_statistics_are_of_all_documents(spark):
    docs = [np.array(d, "<u2") for d in ([5, 5, 6], [6, 7], [6], [])]
    rows = spark.createDataFrame([(i, i, len(d), d.tobytes()) for i, d in enumerate(docs)],
                                 "key long, h long, n long, ids binary").repartition(3, "key")
    known = packing.statistics(rows, np.dtype("<u2"), 10, 2048)
    assert known.df.tolist() == [0, 0, 0, 0, 0, 1, 3, 1, 0, 0] and (known.n, known.mean) == (4, 1.5)


def check_pieces(rows, ids, times=None):
    """The documents in the pieces, each of them covered exactly as often as `times` says (once)."""
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        covered[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, parts in covered.items():
        assert sorted(p for s, n in parts for p in range(s, s + n)) == sorted(list(range(len(ids[k]))) * (times or {}).get(k, 1))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0 and at < 2048
    return set(covered)


def fair(budget, children):
    """Water filling of {name: (cap, weight)}, one saturated child at a time."""
    out, open_ = {}, dict(children)
    while open_:
        total = sum(w for _, w in open_.values())
        full = [n for n, (cap, w) in open_.items() if cap <= budget * w / total + 1e-9]
        if not full:
            return out | {n: budget * w / total for n, (_, w) in open_.items()}
        for n in full:
            out[n] = open_.pop(n)[0]
            budget -= out[n]
    return out


def test_mixing(spark, texts):
    docs = table(spark, SF_DIR, "documents")
    meta = {r["doc_id"]: (f"domain{int(r['source'][3:]) % 5}", r["lang"], r["source"]) for r in docs.collect()}
    tokens_of = {k: len(words(t)) for k, t in texts.items()}
    supply = defaultdict(int)
    for k, path in meta.items():
        supply[path] += tokens_of[k]
    total, weights = 0.8 * sum(supply.values()), {("domain0",): 0.0, ("domain1",): 1e9}

    def share(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        kids = defaultdict(int)
        for path, n in supply.items():
            if path[:len(prefix)] == prefix:
                kids[path[:len(prefix) + 1]] += n
        cut = fair(budget, {n: (2.0 * s, weights.get(n, s ** 0.7) or 1e-300) for n, s in kids.items()})
        return {p: b for n, v in cut.items() for p, b in share(n, v).items()}

    goal = share((), total)
    rows = mixing.mix(docs, queries.mix_levels(), total=total, weights=weights).collect()
    taken, by_epoch = defaultdict(int), defaultdict(set)
    for r in rows:
        path = (r["mix_domain"], r["mix_lang"], r["mix_source"])
        assert path == meta[r["doc_id"]] and r["n_tokens"] == tokens_of[r["doc_id"]]
        taken[path] += r["n_tokens"]
        by_epoch[path, r["epoch"]].add(r["doc_id"])
    longest = defaultdict(int)
    for k, path in meta.items():
        longest[path] = max(longest[path], tokens_of[k])
    for path, budget in goal.items():
        assert budget - 1e-3 <= taken[path] <= budget + longest[path]  # ends with the document that reaches the budget
    for path in goal:
        assert by_epoch[path, 1] <= by_epoch[path, 0]
    again = mixing.mix(docs, queries.mix_levels(), total=total, weights=weights).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_pipeline_by_brute_force(spark, texts, tmp_path):
    from tokenizers import Tokenizer

    docs = table(spark, SF_DIR, "documents")
    steps, taken = [docs], {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, steps[-1], SF_DIR).write.parquet(f"{tmp_path}/{name}")
        steps.append(spark.read.parquet(f"{tmp_path}/{name}"))
    rows = [{r["doc_id"]: r for r in s.collect()} for s in steps]
    judge = language.Judge(language.learn(docs))
    assert set(rows[1]) == {k for k, t in texts.items() if not judge(t)[2]}
    assert set(rows[2]) == one_of_each({k: r["text"] or "" for k, r in rows[1].items()}, 80)
    guess = secrets.Memo(secrets.Guesser(queries.word_list()).cost)
    for k, r in rows[3].items():
        assert r["text"] == secrets.redact(texts[k], secrets.scan(texts[k], guess)) and r["n_chars"] == len(r["text"])
        assert not secrets.ACCESS.search(r["text"]) and not secrets.HEX.search(r["text"])
    for r in steps[4].collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
    assert set(taken) <= set(rows[3]) and steps[4].columns == docs.columns
    assert_mixed({k: r for k, r in rows[3].items()}, taken)
    tokenizer = Tokenizer.from_str(queries.tokenizer())
    ids = {k: np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for k, r in rows[4].items()}
    assert check_pieces(corpus_pipeline.run(spark, SF_DIR).collect(), ids, taken) == set(rows[4])


def one_of_each(texts, percent):
    """The least id of each class of texts linked by their 5-word shingles, by all pairs."""
    sets = {k: near.word_sets(t.encode()) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) > 0 and (n := len(x & y)) \
                and 100 * n >= percent * (len(x) + len(y) - n):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {find(k) for k in sets}


def assert_mixed(rows, taken):
    """Leaves take tokens by water filling of all tokens there are, with weights of the supplies, from two epochs."""
    n_tokens = {k: len(words(r["text"] or "")) for k, r in rows.items()}
    path = {k: (f"domain{int(r['source'][3:]) % 5}", r["lang"] or "", r["source"]) for k, r in rows.items()}
    supply, got, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for k, n in n_tokens.items():
        supply[path[k]] += n
        got[path[k]] += n * taken.get(k, 0)
        longest[path[k]] = max(longest[path[k]], n)

    def share(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        kids = defaultdict(int)
        for p, n in supply.items():
            if p[:len(prefix)] == prefix:
                kids[p[:len(prefix) + 1]] += n
        cut = fair(budget, {p: (2.0 * n, n ** 0.7 or 1e-300) for p, n in kids.items()})
        return {p: b for n, v in cut.items() for p, b in share(n, v).items()}

    for p, budget in share((), float(sum(supply.values()))).items():
        assert budget - 1e-3 <= got[p] <= budget + longest[p]


def test_mixing_query_with_its_own_total(spark):
    docs = table(spark, SF_DIR, "documents")
    taken, rows = defaultdict(int), {r["doc_id"]: r for r in docs.collect()}
    for r in Q["op10_mixing"](spark, SF_DIR).collect():
        taken[r["doc_id"]] += 1
        assert r["n_tokens"] == len(words(rows[r["doc_id"]]["text"] or ""))
    assert_mixed(rows, taken)


def test_toxicity_query_by_hand(spark, texts):
    """Scores are a logistic sum over a text's distinct words; learning sees the labels of the other folds alone."""
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    held = {k: zlib.crc32(str(k).encode()) % 3 == 1 for k in texts}
    model = toxicity.train(docs, labels.filter(~F.col("doc_id").isin([k for k in held if held[k]])))
    flipped = labels.withColumn("toxic", F.when(F.col("doc_id").isin([k for k in held if held[k]]), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    assert toxicity.train(docs, flipped.filter(~F.col("doc_id").isin([k for k in held if held[k]]))) == model
    for r in Q["op1_toxicity"](spark, SF_DIR).collect():
        z = model.bias + sum(model.weights.get(w, 0.0) for w in set(re.findall(r"\w+", texts[r["doc_id"]].lower())))
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == held[r["doc_id"]]


def test_language_query_by_hand(spark, texts):
    import xxhash
    import zstandard

    docs = table(spark, SF_DIR, "documents")
    held = {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in texts}
    learnt = docs.filter(~F.col("doc_id").isin([k for k in held if held[k]]))
    known = language.learn(learnt)
    first = defaultdict(list)  # whole texts in the order of a hash of their key, as long as they fit
    for r in learnt.filter("lang IS NOT NULL AND text IS NOT NULL").collect():
        h = xxhash.xxh64(r["doc_id"].to_bytes(8, "little"), seed=42).intdigest()
        first[r["lang"]].append((h - (1 << 64) if h >> 63 else h, r["text"].lower()))
    for name, rows in first.items():
        ordered = [t for _, t in sorted(rows)[:language.ROWS]]
        room = itertools.accumulate(len(t.encode()) + 1 for t in ordered)
        assert known[name] == "\n".join(t for t, n in zip(ordered, room) if n <= language.BYTES).encode()

    def size(data, content):
        level = 7 if len(data) > 200 else 19
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        c = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(c.compress(data))

    for r in Q["op6_language"](spark, SF_DIR).collect():
        text = texts[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]]
        if not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif len(text.encode()) < 50_000:
            sizes = sorted((size(text.lower().encode(), c), -len(c), n) for n, c in known.items())
            assert r["lang_pred"] == sizes[0][2] and r["score"] == pytest.approx(1 - sizes[0][0] / sizes[1][0])


def test_token_query_by_greedy_search(spark, texts):
    from sentencepiece import SentencePieceProcessor
    import public_tokenizers

    model = SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    longest = max(map(len, pieces))

    def size(word):
        word, n = "▁" + word, 0
        while word:
            end = next((e for e in range(min(longest, len(word)), 0, -1) if word[:e] in pieces), 0)
            if not end:
                return None
            word, n = word[end:], n + 1
        return n

    for r in Q["op7_tokens"](spark, SF_DIR).collect():
        sizes = [size(w) for w in texts[r["doc_id"]].split()]
        unknown = sizes.count(None)
        assert (r["n_words"], r["n_unknown"]) == (len(sizes), unknown)
        assert r["n_tokens"] == sum(n for n in sizes if n is not None) + unknown


def fingerprint_of(text):
    """The fingerprint in plain Python: least hash of each bin, empty bins filled along their walk, low bytes."""
    import xxhash

    def chained(values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64(v.to_bytes(8, "little"), seed=seed).intdigest()
        return seed

    w = words(text)
    if not w:
        return ""
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in w]
    found = [chained(hashes[i:i + 5]) for i in range(len(w) - 4)] if len(w) > 4 else \
        [xxhash.xxh64(" ".join(w).encode(), seed=42).intdigest()]
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    bins = {}
    for h in sorted(found, key=signed):
        bins.setdefault(h >> 57, h)

    def value(b):
        start, stride = (b * 2347 + 1021) % 8191, (b * 5471 + 3371) % 8191 | 1
        return next(bins[p] for p in ((start + t * stride) % 128 for t in range(128)) if p in bins)

    return "".join(f"{(bins[b] if b in bins else value(b)) & 255:02x}" for b in range(128))


def like(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    same = sum(a[i:i + 2] == b[i:i + 2] for i in range(0, 256, 2))
    return max(0.0, (same / 128 - 1 / 256) / (1 - 1 / 256))


def test_fingerprint_query_by_brute_force(spark, texts):
    ids = sorted(texts, reverse=True)
    found = {r["doc_id"]: r for r in Q["op8_fingerprint"](spark, SF_DIR).collect()}
    assert set(found) == set(ids)
    for i, k in enumerate(ids):
        t, then = texts[k], texts[ids[(i + 1) % len(ids)]]
        half = len(t) // 2
        own, edited = fingerprint_of(t), fingerprint_of(t[:len(t) - half] + then[:half])
        assert (found[k]["n_chars"], found[k]["fingerprint"], found[k]["edited_fingerprint"]) == (len(t), own, edited)
        assert found[k]["near_edited"] == pytest.approx(like(own, edited))
        assert found[k]["near_next"] == pytest.approx(like(own, fingerprint_of(then)))


def test_likeness_of_short_texts():
    """Sets of 1 to 12 shingles, where nearly all bins are filled from others: a mean error within 0.05, unbiased to 0.03."""
    r = random.Random(11)
    off = []
    for _ in range(400):
        n = r.randint(1, 12)
        a = [f"w{r.getrandbits(40)}" for _ in range(n + 4)]
        cut = r.randint(0, n)
        b = a[:len(a) - cut] + [f"w{r.getrandbits(40)}" for _ in range(cut)]
        x, y = ({tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (a, b))
        off.append(like(fingerprint_of(" ".join(a)), fingerprint_of(" ".join(b))) - len(x & y) / len(x | y))
    assert abs(np.mean(off)) < 0.03 and np.mean(np.abs(off)) < 0.05
    for b in range(128):  # every walk asks all bins
        start, stride = (b * 2347 + 1021) % 8191, (b * 5471 + 3371) % 8191 | 1
        assert len({(start + t * stride) % 128 for t in range(128)}) == 128


def test_quality_verdict_on_held_out_labels(spark):
    from opsight.llm import quality

    sf = SF_DIR.rsplit("/", 1)[0] + "/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    learn = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    model = quality.train(docs, labels.filter(learn))
    rows = quality.assess(docs.join(labels.filter(~learn).select("doc_id"), "doc_id", "left_semi"), model) \
        .join(labels.select("doc_id", "quality"), "doc_id").filter("NOT base_failed").collect()
    assert len(rows) > 1000
    assert np.mean([(r["quality_score"] >= 0.5) == (r["quality"] == 1) for r in rows]) > 0.85
    by_score = sorted(rows, key=lambda r: r["quality_score"])
    low, high = by_score[:len(rows) // 4], by_score[-len(rows) // 4:]
    assert np.mean([r["quality"] for r in high]) > np.mean([r["quality"] for r in low]) + 0.3


def test_quality_grams_are_of_code_points():
    from opsight.llm import quality
    from opsight.llm.common import word_hashes

    texts = ["äöüß".encode(), b"abc", b"", "aäöb".encode()]
    (_, _), (_, _), (gram, owner) = quality.features(texts, *word_hashes(texts))
    assert np.bincount(owner, minlength=4).tolist() == [2, 1, 0, 2]  # the line end is the last code point
    assert len(set(gram.tolist())) == 5


def test_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= {q.split("_")[0] for q in entry.queries()}
    assert json.loads(queries.tokenizer())["model"]
