"""Personal data and secrets: the rules against plain Python, and what the methods add."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from martloom.llm import pii, secret_scan


def luhn(digits):
    twice = [int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(digits))]
    return sum(twice) % 10 == 0


def digits(value):
    return re.sub(r"[^0-9]", "", value)


PII_RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 14 <= len(digits(v)) <= 19 and luhn(digits(v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= len(digits(v)) <= 15),
}
SECRET_RULES = {
    "assign": (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""",
        lambda v: len(re.search(r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", v).group(1)) >= 6,
    ),
    "access": (r"AKIA[A-Z0-9]+", lambda v: len(v) >= 20),
    "hex": (r"[0-9a-f]+", lambda v: len(v) >= 24),
}


def brute_force(text, rules):
    text = text or ""
    found = []
    for rank, (kind, (pattern, fits)) in enumerate(rules.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if fits(m.group())]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def awkward(rng):
    """Texts over the characters that the rules care about."""
    out = []
    for alphabet in ("a@.-b ", "0125. ", "4 -0123456789", "+1 ()-.56", "AKIAZ9 ", "0af g", "token:= \"'x1y", "secret password=:ab12 "):
        out += ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(60)]
    out += ["a@b.c_d@e.f.g", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "token: token: abcdef", "paſſword=abcdefg ToKeN='abcdef",
            "4111 1111 1111 1111", "x@y" + ".z" * 20000, "+" + "1" * 12 + " ()" * 2000, "a" * 30000 + "@", "1." * 20000, "é😀 4111-1111-1111-1111 é"]
    return out


def check(rows, texts, rules):
    for r in rows:
        expected = brute_force(texts[r["doc_id"]], rules)
        assert r["base_sha256"] == hashlib.sha256(",".join(expected).encode()).hexdigest(), (r, expected)
        for kind in rules:
            assert r[f"n_{kind}"] == sum(e.startswith(kind + ":") for e in expected)
        assert set(expected) <= set(r["spans"].split(",")) | {""}


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(awkward(random.Random(6))))


def test_pii_rules_equal_plain_python(make_docs, texts):
    check(pii.digest_columns(pii.extract(make_docs(list(texts.items())))).collect(), texts, PII_RULES)


def test_secret_rules_equal_plain_python(make_docs, texts):
    check(secret_scan.digest_columns(secret_scan.find_secrets(make_docs(list(texts.items())))).collect(), texts, SECRET_RULES)


def test_messy_rows_give_one_row_each(make_docs, messy):
    docs = make_docs(messy)
    for found in (pii.digest_columns(pii.extract(docs)), secret_scan.digest_columns(secret_scan.find_secrets(docs))):
        rows = found.collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in messy)
    assert pii.extract(docs.limit(0)).count() == 0
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0


def test_contexts_of_seeds_discover_unseen_identifiers(make_docs):
    rng = random.Random(2)
    words = ["alder", "birch", "cedar", "dogwood", "elm", "fir"]
    rows = []
    for i in range(60):
        noise = " ".join(rng.choices(words, k=8))
        rows.append((i, f"{noise} please call: +1 (200) 555-{1000 + i} today {noise}"))
    rows += [(100, "cedar please call: 555-0142 today elm"), (101, "birch order 555-0142 shipped elm"), (102, "fir please call: tomorrow today")]
    # The same form in a context without seeds of one kind stays.
    rows += [(103, "cedar counted 5550142777 leaves"), (104, "nothing here")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest_columns(pii.extract(make_docs(rows))).collect()}
    assert got[100] == "phone:19:27"
    assert all(got[i] == "" for i in (101, 102, 103, 104))


def test_network_finds_unlabelled_secrets_and_leaves_words_alone():
    rng = random.Random(7)
    words = ["alder", "birchwood", "cedarhouse", "dogwood", "elmstreet", "firtrees"]

    def text(middle):
        return f"{' '.join(rng.choices(words, k=6))} {middle} {' '.join(rng.choices(words, k=6))}"

    def key(n):
        return "".join(rng.choices("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=n))

    windows, labels = [], []
    for i in range(600):
        secret = i % 2 == 0
        body = key(rng.randint(16, 40)) if secret else rng.choice([rng.choice(words) + rng.choice(words), f"chapter{rng.randint(1, 99)}_section{rng.randint(1, 9)}"])
        whole = text(f'token = "{body}"' if secret else body)
        at = whole.index(body)
        windows.append(secret_scan.span_codes(whole, at, at + len(body)))
        labels.append(float(secret))
    net = secret_scan.train(windows, np.array(labels))
    assert net.recall > 0.9 and net.false_alarms < 0.1
    bare = [text(key(24)) for _ in range(100)]
    looks = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{12,}")
    found = [secret_scan.window(t, *looks.search(t).span()) for t in bare if looks.search(t)]
    assert (net.score(found) >= net.threshold).mean() > 0.8
    plain = [secret_scan.window(t, t.index("chapter"), t.index("chapter") + 17) for t in (text(f"chapter{i}_section7") for i in range(10, 99))]
    assert (net.score(plain) >= net.threshold).mean() < 0.05


def test_network_gradients_equal_differences():
    rng = np.random.default_rng(3)
    windows = [bytes(rng.integers(0, 60, secret_scan._SIZE).astype(np.uint8)) for _ in range(6)]
    labels = np.array([1.0, 0, 1, 0, 1, 0])
    net = secret_scan.Network(
        rng.normal(0, 0.5, (3 * secret_scan._CLASSES, secret_scan.EMBEDDING)),
        rng.normal(0, 0.3, (secret_scan.WIDTH * secret_scan.EMBEDDING, secret_scan.FILTERS)),
        rng.normal(0, 0.1, secret_scan.FILTERS), rng.normal(0, 0.3, 2 * secret_scan.FILTERS + 1),
    )
    codes = secret_scan.to_codes(windows)

    def loss():
        z = net.raw(codes)
        return np.mean(np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)) + 0.5e-4 * (net.dense**2).sum()

    slopes = secret_scan._gradients(net, codes, labels, np.ones(6))
    for values, slope in zip((net.embedding, net.filters, net.shift, net.dense), slopes, strict=True):
        for at in rng.choice(values.size, 4, replace=False):
            before, step = values.flat[at], 1e-5
            values.flat[at] = before + step
            up = loss()
            values.flat[at] = before - step
            down = loss()
            values.flat[at] = before
            assert abs((up - down) / (2 * step) - slope.flat[at]) < 1e-5


def test_no_findings_no_network():
    assert secret_scan.train([], np.zeros(0)) is None
    assert secret_scan.train([b"\0" * secret_scan._SIZE] * 50, np.zeros(50)) is None


def _trained(seed=7, n=600):
    rng = random.Random(seed)
    words = ["alder", "birchwood", "cedarhouse", "dogwood", "elmstreet", "firtrees", "reports", "archive", "gardens"]

    def key(size):
        return "".join(rng.choices("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=size))

    windows, labels = [], []
    for i in range(n):
        secret = i % 2 == 0
        body = key(rng.randint(8, 40)) if secret else rng.choice([rng.choice(words), "/" + "/".join(rng.choices(words, k=5))])
        whole = f"elm fir {'token = ' if secret else 'see '}{body} dogwood alder"
        at = whole.index(body, 11 if not secret else 16)
        windows.append(secret_scan.span_codes(whole, at, at + len(body)))
        labels.append(float(secret))
    return secret_scan.train(windows, np.array(labels)), key, words


def _span_scores(net, text):
    codes, first, _, start, end = secret_scan._block([text])
    return {text[a - first[0] : b - first[0]]: s for a, b, s in zip(start, end, net.score_spans(codes, start, end), strict=True)}


def test_network_sees_whole_candidates():
    net, key, words = _trained()
    found = clean = 0
    for _ in range(40):
        path = "/srv/" + "/".join(random.Random(3).choices(words, k=8)) + "/"
        assert len(path) > secret_scan.BODY
        got = _span_scores(net, f"elm see {path}{key(40)} dogwood")
        # The largest score over all places of the body, as the slow form gives it.
        text = f"elm see {path}{key(40)} dogwood"
        (value, score), = ((v, s) for v, s in _span_scores(net, text).items() if v.startswith(path))
        slow = net.score([secret_scan.window(text, 8, 8 + len(value), at) for at in range(len(value) - secret_scan.BODY + 1)]).max()
        assert abs(score - slow) < 1e-3
        found += max(s for v, s in got.items() if v.startswith(path)) >= net.threshold
        clean += max(_span_scores(net, f"elm see {path}{words[0]} dogwood").values()) >= net.threshold
    assert found > 35 and clean < found


def test_candidates_reach_down_to_the_rules_length():
    texts = ["pin a1B2c3 and qWxZkV. End", "key.with.dots9 short abc12", "", "token=abcdef/rest99xyz"]
    codes, first, _, start, end = secret_scan._block(texts)
    rows = np.searchsorted(first, start, "right") - 1
    got = [texts[r][a - first[r] : b - first[r]] for r, a, b in zip(rows, start, end, strict=True)]
    assert got == ["a1B2c3", "qWxZkV", "key.with.dots9"]


def test_short_and_long_spans_score_alike_in_both_forms():
    net, key, _ = _trained(n=200)
    for size in (6, 11, 12, 19, 20, 43, 48, 49):
        body = key(size)
        text = f"ab {body} cd"
        assert abs(_span_scores(net, text)[body] - net.score([secret_scan.window(text, 3, 3 + size, at) for at in range(max(1, size - 47))]).max()) < 1e-3


def test_threshold_keeps_the_recall_of_findings_that_look_ordinary():
    rng = np.random.default_rng(4)
    labels = np.repeat([1.0, 0.0], 400)
    raw = rng.normal(0, 1, 800) + 0.7 * labels
    net = secret_scan.Network(np.zeros(1), np.zeros(1), np.zeros(1), np.zeros(1))
    secret_scan._calibrate(net, raw, labels)
    scores = 1 / (1 + np.exp(-(net.slope * raw + net.offset)))
    assert (scores[labels > 0] >= net.threshold).mean() >= secret_scan.RECALL
    assert net.threshold < 0.5


def _plain_scores(net, codes, start, end):
    """The largest score over all places, window by window."""
    out = []
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        windows = []
        for at in range(max(1, b - a - secret_scan.BODY + 1)):
            body = codes[a + at : min(b, a + at + secret_scan.BODY)]
            row = np.zeros(secret_scan._SIZE, np.uint8)
            row[: secret_scan.LEFT] = codes[a - secret_scan.LEFT : a]
            row[secret_scan.LEFT : secret_scan.LEFT + len(body)] = body
            row[secret_scan.LEFT + secret_scan.BODY :] = codes[b : b + secret_scan.RIGHT]
            windows.append(row.tobytes())
        out.append(net.score(windows).max())
    return np.array(out)


def test_running_maxima_equal_window_by_window_scores(monkeypatch):
    rng = random.Random(13)
    net, key, words = _trained(n=200)
    texts = [f"{rng.choice(words)} {key(rng.choice([6, 47, 48, 49, 50, 91, 92, 200, 333]))}{rng.choice(['', ' ', '='])} {rng.choice(words)}" for _ in range(25)] + ["", key(120), key(60) + "\n" + key(48)]
    codes, _, _, start, end = secret_scan._block(texts)
    expected = _plain_scores(net, codes, start, end)
    for places in (1 << 13, 50):
        monkeypatch.setattr(secret_scan, "_PLACES", places)
        assert np.abs(net.score_spans(codes, start, end) - expected).max() < 1e-3


def test_one_candidate_of_millions_of_characters():
    import time

    net, key, _ = _trained(n=200)
    text = "see " + "abcdefgh/" * 250_000 + key(40) + " end"
    codes, _, _, start, end = secret_scan._block([text])
    began = time.time()
    scores = net.score_spans(codes, start, end)
    assert len(scores) == 1 and time.time() - began < 60
    tail = secret_scan._block([text[-300:]])
    assert scores.max() >= net.score_spans(*(tail[i] for i in (0, 3, 4))).max() - 0.2


def test_added_spans_of_whole_texts_equal_a_slow_scan(make_docs, monkeypatch):
    rng = random.Random(17)
    _, key, words = _trained(n=40)
    rows = [(i, f"{rng.choice(words)} token = {key(rng.randint(8, 40))} {rng.choice(words)}") for i in range(120)]
    rows += [(1000 + i, f"{rng.choice(words)} {key(rng.choice([20, 60]))} {'/'.join(rng.choices(words, k=9))}") for i in range(40)]
    held = []
    plain = secret_scan.train
    monkeypatch.setattr(secret_scan, "train", lambda *a: held.append(plain(*a)) or held[-1])
    got = secret_scan.find_secrets(make_docs(rows)).select("row.doc_id", "added").collect()
    (net,) = held
    texts, found = dict(rows), 0
    for r in got:
        codes, first, _, start, end = secret_scan._block([texts[r["doc_id"]]])
        scores = _plain_scores(net, codes, start, end)
        near = {(int(a - first[0]), int(b - first[0])) for a, b, s in zip(start, end, scores, strict=True) if abs(s - net.threshold) < 1e-3}
        expected = {(int(a - first[0]), int(b - first[0])) for a, b, s in zip(start, end, scores, strict=True) if s >= net.threshold}
        assert ({(x["start"], x["end"]) for x in r["added"]} ^ expected) <= near
        found += len(expected)
    assert found > 10


def test_discovered_identifiers_induce_patterns_and_many_candidates_keep_the_score(make_docs):
    rows = [(i, f"elm please call: +1 (200) 555-{1000 + i} today") for i in range(6)]
    # Twenty candidates for each seed in a seeded template.
    rows += [(100 + i, f"elm please call: 555-{2000 + i} today") for i in range(120)]
    # A template without seeds, reached by numbers that were found above, and other numbers in it.
    rows += [(300 + i, f"birch office tel. 555-{2000 + i} fir") for i in range(8)] + [(400 + i, f"birch office tel. 555-{7000 + i} fir") for i in range(8)]
    # Addresses with few digits, out of the rules' range, in a template of addresses.
    rows += [(500 + i, f"cedar host: 10.0.0.{i} up") for i in range(6)] + [(600, "cedar host: 1.2.3.444 up"), (601, "cedar host: 1:2:3:4 up")]
    rows += [(700 + i, f"dogwood counted 555-{8000 + i} leaves") for i in range(8)]
    got = {r["doc_id"]: r["spans"] for r in pii.digest_columns(pii.extract(make_docs(rows))).collect()}
    assert all(got[100 + i].startswith("phone:17:") for i in range(120))
    assert all(got[i].startswith("phone:18:") for i in (*range(300, 308), *range(400, 408)))
    assert got[600].startswith("ip:12:") and got[601].startswith("ip:12:")
    assert all(got[700 + i] == "" for i in range(8))


def bootstrap(found):
    """The scores and new spans of ``pii.discover`` in plain Python."""
    import math

    edges = {}
    for r in found:
        for s in r["base"]:
            for p in s["patterns"]:
                edges[p, s["value"], s["kind"]] = True
        for s in r["like"]:
            for p in s["patterns"]:
                for k in s["kinds"]:
                    edges.setdefault((p, s["value"], k), False)
    values = {}
    for p, v, _ in edges:
        values.setdefault(p, set()).add(v)
    seeds = {}
    for (p, _, k), seed in edges.items():
        if seed:
            seeds[p, k] = seeds.get((p, k), 0) + 1
    unknown = [e for e, seed in edges.items() if not seed]
    score = {pk: n / (len(values[pk[0]]) + 1) for pk, n in seeds.items()}
    support = dict(seeds)
    total = sum(score.values())
    for _ in range(pii.MOST if total else 0):
        doubt = {pk: math.log1p(-s) for pk, s in score.items() if s >= pii._LEAST}
        doubts = {}
        for p, v, k in unknown:
            if (p, k) in doubt:
                doubts[v, k] = doubts.get((v, k), 0.0) + doubt[p, k]
        heard, strong = {}, {}
        for p, v, k in unknown:
            if (v, k) in doubts:
                said = 1 - math.exp(doubts[v, k] - doubt.get((p, k), 0.0))
                heard[p, k] = heard.get((p, k), 0.0) + said
                strong[p, k] = strong.get((p, k), 0) + (said >= pii.CONFIDENCE)
        names = set(seeds) | set(heard)
        score = {pk: (seeds.get(pk, 0) + heard.get(pk, 0.0)) / (len(values[pk[0]]) + 1) for pk in names}
        support = {pk: seeds.get(pk, 0) + strong.get(pk, 0) for pk in names}
        before, total = total, sum(score.values())
        if total - before < pii._REST * before:
            break
    sure = {pk: s for pk, s in score.items() if s >= pii.CONFIDENCE and support[pk] >= pii.SUPPORT}
    out = set()
    for r in found:
        for s in r["like"]:
            kinds = [(sure[p, k], k) for p in s["patterns"] for k in s["kinds"] if (p, k) in sure]
            if kinds:
                out.add((r["id"], max(kinds)[1], s["start"], s["end"], s["value"]))
    return out


def test_discovery_equals_a_plain_bootstrap(make_docs, messy):
    rng = random.Random(23)
    makers = {
        "phone": lambda: f"+1 (20{rng.randint(0, 9)}) 555-{rng.randint(1000, 9999)}", "local": lambda: f"555-{rng.randint(1000, 1040)}",
        "email": lambda: f"{rng.choice('abcdef')}{rng.randint(1, 60)}@mail.example", "odd": lambda: f"{rng.choice('abcdef')}{rng.randint(1, 20)}@intern",
        "ip": lambda: f"10.0.{rng.randint(0, 9)}.{rng.randint(0, 99)}", "wrong": lambda: f"10.0.{rng.randint(300, 310)}.{rng.randint(0, 9)}",
    }
    frames = ["please call: {} today", "office tel. {} or so", "mail to {} soon", "host {} is up", "ref #{} done", "counted {} leaves"]
    kinds = [["phone", "local", "local"], ["local"], ["email", "odd"], ["ip", "wrong", "ip"], ["phone", "ip", "local", "email"], ["local"]]
    rows = list(messy)
    for i in range(500):
        f = rng.randrange(len(frames))
        rows.append((1000 + i, "elm " + frames[f].format(makers[rng.choice(kinds[f])]()) + " fir"))
    found = pii.identifiers(make_docs(rows))
    expected = bootstrap(found.collect())
    got = {(r["id"], s["kind"], s["start"], s["end"], s["value"]) for r in pii.discover(found).collect() for s in r["added"]}
    assert got == expected and len(expected) > 50


def test_the_nearest_words_count_whatever_lies_between(make_docs):
    near = make_docs([(1, "say please call: +1 (200) 555-0142 today"), (2, "say please" + " " * 90 + "call:" + "\n" * 200 + "+1 (200) 555-0142" + "\t" * 99 + "today")])
    rows = pii.identifiers(near).collect()
    patterns = [[s["patterns"] for s in r["base"]] for r in rows]
    assert patterns[0] == patterns[1] == [["2 please call:", "b call: today", "1 call:"]]
    edge = pii.identifiers(make_docs([(1, "+1 (200) 555-0142"), (2, "x" * 5000 + "= +1 (200) 555-0142 " + "y" * 5000)])).orderBy("id").collect()
    assert edge[0]["base"][0]["patterns"] == ["2 ^ ^", "b ^ $"]
    assert edge[1]["base"][0]["patterns"][1] == "b " + "x" * 47 + "= " + "y" * 48
