import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlink.llm import decontaminate, jaccard, pii, quality

from . import cases

# --- benchmark passages ----


def plain_windows(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(rows, items):
    made = []
    for key, text, *_ in rows:
        words, hit, found = plain_windows(text), set(), set()
        for item, body in items:
            own = plain_windows(body)
            size = min(10, len(own))
            windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own and item is not None else set()
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    found.add(str(item))
        listed = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        made.append((key, len(words), len(hit), len(found), listed, bool(hit)))
    return made


def benchmark_case():
    chance = random.Random(8)
    prose = cases.prose(1, 30)
    items = [(k, t) for k, t in enumerate(prose[:12])]
    items += [(12, "a a a a a a a a a a a a"), (13, "aba cdd"), (14, "ONE two"), (15, None), (None, prose[13]), (3, prose[3]), (16, prose[0]), (17, "!!")]
    extra = list(prose[12:])
    for item, body in items[:14] * 3:
        words = body.split()
        low = chance.randint(0, max(0, len(words) - 9))
        piece = words[low : low + chance.randint(8, 14)]
        extra.append(" ".join([*chance.choice(prose).split()[:20], *piece, *chance.choice(prose).split()[:9]]).upper())
    return items, [*extra, "a " * 300, "b a " * 40, "", "éa1 " * 10]


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 700])
def test_find_items(spark, block_chars):
    items, extra = benchmark_case()
    table = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, key string")
    frame = cases.documents(spark, extra, clashing=True)
    rows = cases.rows(extra)
    expected = plain_hits(rows, items)
    assert sum(e[5] for e in expected) > 10 and not all(e[5] for e in expected)
    cases.same(decontaminate.find_items(frame, table, block_chars=block_chars), expected)
    clean = [r[:5] for r, e in zip(rows, expected, strict=True) if not e[5]]
    cases.same(decontaminate.keep_clean(frame, table).select("doc_id", "text", "lang", "source", "n_chars"), clean)


def test_no_items(spark):
    table = spark.createDataFrame([], "item_id bigint, text string")
    assert {r.n_items for r in decontaminate.find_items(cases.documents(spark), table).collect()} == {0}
    assert decontaminate.find_items(cases.documents(spark).limit(0), table).count() == 0


def test_winnow_shares_a_print_of_every_window():
    chance = np.random.default_rng(3)
    shared = chance.integers(1, 5, 10)
    for _ in range(300):
        sides = []
        for _ in range(2):
            text = np.concatenate((chance.integers(1, 5, chance.integers(0, 9)), shared, chance.integers(1, 5, chance.integers(0, 9))))
            hashes = decontaminate.gram_hashes(text, decontaminate.GRAM)
            sides.append(set(hashes[decontaminate.winnow(hashes)].tolist()))
        assert sides[0] & sides[1]


# --- personal data ----


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    return [(k, *m.span()) for k, (pattern, good) in kinds.items() for m in re.finditer(pattern, text) if good(m[0])]


def test_base_spans():
    chance = random.Random(4)
    parts = ["a", "b.", "@", "@", ".", "x.y", "1", "25", "255.", "300", ".4", " ", "-", "+", "(", ")", "é", "4111111111111111", "5500 0000-0000 0004", "\n"]
    for _ in range(20_000):
        text = "".join(chance.choices(parts, k=chance.randint(0, 22)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_spans_of_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 " * 150_000):
        pii.base_spans(text)


def pii_rows():
    filler = cases.prose(2, 60)
    rows = [f"{filler[k]} zephyrine mails to boss@corp.example.org about it" for k in range(4)]
    rows += [f"{filler[k]} mails to other{k}@corp.example.org about it" for k in range(10, 40)]
    rows += [f"{filler[k]} zephalous zephonic zephirum words" for k in range(40, 58)]
    return rows


def test_terms_that_give_away(spark):
    rows = cases.rows(pii_rows())
    documents = len(rows)
    made = pii.find(cases.documents(spark, pii_rows(), clashing=True)).collect()
    assert len(made) == len(rows)
    found = {(r.doc_id, r.spans): r for r in made}
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for (key, spans), row in found.items():
        text = texts.get(key, "")
        base = plain_base(text)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and spans.startswith(listed)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        terms = [(text[t.start : t.end], t.action) for t in row.term_spans]
        # Four documents have the address and the word, no other has the word, many have its prefix.
        assert ("zephyrine", "generalised") in terms if "boss@" in text else not terms
    both = docs = 4
    assert math.isclose(math.log(documents * both / (4 * docs)) / math.log(documents / 4), 1.0)
    clean = pii.sanitise(cases.documents(spark, pii_rows(), clashing=True))
    assert clean.columns == cases.documents(spark, clashing=True).columns
    for row in clean.collect():
        original = texts.get(row.doc_id)
        if "boss@" in (original or ""):
            assert "zep* mails to [EMAIL] about it" in row.text
        elif row.doc_id is not None and not plain_base(original) and row.text is not None:
            assert row.text == original
    assert clean.count() == documents
    assert sum(r.text is None for r in clean.collect()) == sum(r[1] is None for r in rows)


def plain_terms(rows, support=3, threshold=0.8):
    """The term spans of each row, from all pairs of words and entities of a document."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans, entities, words, docs = [], [], [], []
    for text in (r[1] or "" for r in rows):
        base = plain_base(text)
        found = [(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W_]+", text)]
        entities.append({f"{k}:{text[s:e].lower() if k in ('email', 'ip') else digits(text[s:e])}" for k, s, e in base})
        spans.append([w for w in found if all(w[2] <= s or w[1] >= e for _, s, e in base)])
        forms = lambda own: {w for w, *_ in own} | {f"{w[:3]}*" for w, *_ in own if len(w) >= 5}
        words.append(forms(spans[-1]))
        docs.append(forms(found))
    actions, total = {}, len(rows)

    def disclosure(name, term):
        both = sum(name in e and term in w for e, w in zip(entities, words, strict=True))
        own, all_ = sum(name in e for e in entities), sum(term in d for d in docs)
        return math.log(total * both / (own * all_)) / math.log(total / own) if both >= support and own < total else -1

    for name in set().union(*entities):
        for term in set().union(*(w for e, w in zip(entities, words, strict=True) if name in e)):
            if not term.endswith("*") and disclosure(name, term) >= threshold:
                general = len(term) >= 5 and disclosure(name, f"{term[:3]}*") < threshold
                actions.setdefault(term, set()).add("generalised" if general else "removed")
    return [[(s, e, max(actions[w])) for w, s, e in own if w in actions] for own in spans]


def test_terms_anywhere(spark):
    """Terms far from the entity, beyond 256 characters, in texts without it, and in runs without spaces."""
    filler = cases.prose(3, 60)
    far = "x" * 300
    extra = [f"quilloMium {filler[k]} {'la ' * 12}{far} chief@corp.example.org {far} {'la ' * 9} " + "日本語" * 100 for k in range(4)]
    extra += [f"{filler[k]} quillomium and Quillomium." for k in range(4, 5)]
    extra += [f"{filler[k]} quills {'' if k % 3 else 'quillotine'} la {far} {'日本語' * (k % 2)}" for k in range(5, 60)]
    extra += ["to +49 30 1234567 vexing", "vexing +49301234567", "İvexing +49 (30) 1234567 vexing a@vexing.org", "ask vexing", "İvexing"]
    rows = cases.rows(extra)
    expected = plain_terms(rows)
    texts = [r[1] or "" for r in rows]
    found = [{(t[s:e].lower(), a) for s, e, a in own} for t, own in zip(texts, expected, strict=True)]
    assert sum(("quillomium", "generalised") in f for f in found) == 5 and sum(("日本語" * 100, "removed") in f for f in found) == 4
    assert sum("vexing" in dict(f) for f in found) == 4
    frame = cases.documents(spark, extra, clashing=True)
    got = [(r.doc_id, [tuple(t) for t in r.term_spans]) for r in pii.find(frame).collect()]
    assert sorted(got, key=repr) == sorted(((r[0], e) for r, e in zip(rows, expected, strict=True)), key=repr)
    assert not any(re.search("quillomium|vexing\\b", (r.text or "").replace("İvexing", "").lower()) for r in pii.sanitise(frame).collect())


def test_redact():
    assert pii.redact("to a@b.cd now", [("email", 3, 9)]) == "to [EMAIL] now"
    assert pii.redact("abcdef 12", [("ip", 7, 9), ("removed", 0, 6)]) == "[TERM] [IP]"
    assert pii.redact("abcdefgh", [("card", 2, 6), ("phone", 4, 7)]) == "ab[CARD]h"


def test_pii_without_rows(spark):
    assert pii.find(cases.documents(spark).limit(0)).count() == 0
    assert pii.sanitise(cases.documents(spark).limit(0)).count() == 0


# --- near duplicates ----


def plain_set(text):
    words = re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    words = [w for w in words if w]
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain_components(rows):
    sets = [plain_set(r[1]) for r in rows]
    label = list(range(len(rows)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[top(a)] = top(b)
    made = []
    for k, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if top(j) == top(k) and rows[j][0] is not None]
        made.append((r[0], len(sets[k]), (min(ids, default=None) if sets[k] else r[0])))
    return made


def near_copies(seed, bases, copies, edits):
    """Copies with so many words changed that similarities lie on both sides of the limit."""
    chance = random.Random(seed)
    made = []
    for base in cases.prose(seed, bases):
        for _ in range(copies):
            words = base.split()
            for _ in range(chance.randint(0, edits)):
                words[chance.randrange(len(words))] = f"new{chance.randrange(10**6)}"
            made.append(" ".join(words[: chance.randint(len(words) * 9 // 10, len(words))]))
    return made


@pytest.mark.parametrize("seed,bases,copies,edits", [(1, 12, 6, 3), (2, 3, 40, 2), (3, 1, 60, 3)])
def test_link(spark, seed, bases, copies, edits):
    extra = near_copies(seed, bases, copies, edits)
    rows = cases.rows(extra)
    frame = cases.documents(spark, extra, clashing=True)
    expected = plain_components(rows)
    assert len({e[2] for e in expected}) < len({e[0] for e in expected})
    cases.same(jaccard.link(frame), expected)
    kept = jaccard.keep_first(frame)
    assert kept.columns == frame.columns
    firsts = sorted({e[0] for e in expected if e[0] is not None and e[0] == e[2]})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == firsts
    assert sum(r.doc_id is None for r in kept.collect()) == 2


def test_one_id_on_different_texts(spark):
    """Rows are dropped only within their own component; rows without words stay, each of them."""
    prose = [t for t in cases.prose(11, 60) if len(t.split()) > 40][:12]
    rows = [(7, t) for t in prose] + [(7, prose[0]), (3, f"{prose[1]} tail"), (9, f"{prose[2]} tail"), (7, " \x0b\n"), (7, " \x0b\n"), (7, None)]
    frame = spark.createDataFrame([(k, t, "z") for k, t in rows], "doc_id bigint, text string, number string").repartition(3)
    kept = [t for t in prose if t != prose[1]]
    expected = [(7, t, "z") for t in kept] + [(3, f"{prose[1]} tail", "z"), (7, " \x0b\n", "z"), (7, " \x0b\n", "z"), (7, None, "z")]
    cases.same(jaccard.keep_first(frame), expected)


def test_every_near_pair_shares_a_signature():
    chance = np.random.default_rng(6)
    tested = 0
    for _ in range(3000):
        size = int(chance.choice([chance.integers(1, 12), chance.integers(12, 90), chance.integers(90, 700)]))
        one = chance.integers(0, 1 << 63, size, dtype=np.uint64)
        gone = int(chance.integers(0, size // 4 + 1))
        added = chance.integers(0, 1 << 63, int(chance.integers(0, size // 4 + 1)), dtype=np.uint64)
        two = np.unique(np.concatenate((one[gone:], added)))
        one = np.unique(one)
        shared = len(np.intersect1d(one, two))
        if len(two) and 100 * shared >= 80 * (len(one) + len(two) - shared):
            tested += 1
            assert np.intersect1d(jaccard.signatures(one), jaccard.signatures(two)).size
    assert tested > 500


def test_no_rows(spark):
    assert jaccard.link(cases.documents(spark).limit(0)).count() == 0
    assert jaccard.keep_first(cases.documents(spark).limit(0)).count() == 0


# --- quality ----


def test_grades(spark):
    chance = random.Random(9)
    filler = cases.prose(5, 3000, 150)
    grades = [k % 3 for k in range(3000)]
    extra = [f"{t} {'vile' if g == 0 else ''} {'!!! ' * 40 if g == 1 else ''}" for t, g in zip(filler, grades, strict=True)]
    first = len(cases.TEXTS)
    labels = [(first + k, int(g == 2), int(g == 0)) for k, g in enumerate(grades) if chance.random() < 0.6] + [(None, 1, 0), (0, None, None)]
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    frame = cases.documents(spark, extra, clashing=True)
    judged = quality.grade(frame, quality.grades_of(table), 3, 2).collect()
    assert len(judged) == len(cases.rows(extra))
    known = {k for k, *_ in labels}
    rest = [(r, grades[r.doc_id - first]) for r in judged if r.doc_id is not None and r.doc_id >= first and r.doc_id not in known]
    assert np.mean([r.keep == (g == 2) for r, g in rest]) > 0.9
    for r in judged:
        assert math.isclose(r.expected_grade, sum(r.tail)) and r.tail[0] >= r.tail[1] and r.keep == (r.tail[1] >= 0.5)
    kept = quality.keep_good(frame, quality.grades_of(table), 3, 2)
    assert kept.columns == frame.columns
    cases.same(kept.select("doc_id", "text"), [(r[0], r[1]) for r in cases.rows(extra) if any(j.keep for j in judged if j.doc_id == r[0])])


def plain_loss(rows, grades, weights, cuts):
    """Mean of minus the log likelihood, and the penalty, term by term."""
    total = 0.0
    for places, grade in zip(rows, grades, strict=True):
        score = sum(weights[p] for p in places)
        below = [0.0, *(1 / (1 + math.exp(score - c)) for c in cuts), 1.0]
        total -= math.log(below[grade + 1] - below[grade])
    return total / len(rows) + quality.PENALTY / 2 * sum(w * w for w in weights.values())


def test_fit_is_at_the_least_loss():
    chance = random.Random(4)
    rows = [np.array(sorted({0, *chance.sample(range(1, 9), 3)}), np.int32) for _ in range(400)]
    noisy = [sum(int(p) for p in r) + chance.gauss(0, 4) for r in rows]
    grades = [0 if x < 11 else 1 if x < 15 else 2 for x in noisy]
    model = quality.fit(rows, np.array(grades), 3)
    weights, cuts = {p: float(model.weights[p]) for p in range(9)}, list(model.thresholds)
    assert cuts == sorted(cuts) and not model.weights[9:].any()
    least = plain_loss(rows, grades, weights, cuts)
    for p in range(9):  # the slope of the plain loss is flat at the fitted weights and thresholds
        up, down = ({**weights, p: weights[p] + e} for e in (1e-4, -1e-4))
        assert abs(plain_loss(rows, grades, up, cuts) - plain_loss(rows, grades, down, cuts)) / 2e-4 < 5e-3
    for k in range(2):
        up, down = ([c + e * (i == k) for i, c in enumerate(cuts)] for e in (1e-4, -1e-4))
        assert abs(plain_loss(rows, grades, weights, up) - plain_loss(rows, grades, weights, down)) / 2e-4 < 5e-3
    assert least < plain_loss(rows, grades, dict.fromkeys(weights, 0.0), cuts)


def test_grades_follow_from_the_weights(spark):
    texts = [f"{t} {'good' * (k % 3 == 2)} {'bad' * (k % 3 == 0)}" for k, t in enumerate(cases.prose(6, 300, 60))]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "key bigint, text string")
    ratings = spark.createDataFrame([(k, k % 3) for k in range(300)] + [(0, 0), (1, 2)], "key bigint, grade int")
    hot = frame.unionByName(frame.filter("key = 0").withColumn("key", F.explode(F.array_repeat("key", 500))))
    model, again = quality.train(frame, ratings, 3), quality.train(hot.repartition(5), ratings, 3)
    assert (model.weights == again.weights).all() and (model.thresholds == again.thresholds).all()
    for r in quality.grade(frame, ratings, 3, 2, key="key").collect():
        score = sum(model.weights[p] for p in quality.features(texts[r.key]))
        tail = [1 / (1 + math.exp(cut - score)) for cut in model.thresholds]
        assert np.allclose(r.tail, tail) and math.isclose(r.expected_grade, sum(tail)) and r.keep == (tail[1] >= 0.5)


@pytest.mark.parametrize("labels", [[], [(3, 1, 0), (4, 1, 0)]])
def test_nothing_to_learn(spark, labels):
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert quality.keep_good(cases.documents(spark), quality.grades_of(table), 3, 2).count() == len(cases.rows())
    assert quality.grade(cases.documents(spark).limit(0), quality.grades_of(table), 3, 2).count() == 0
