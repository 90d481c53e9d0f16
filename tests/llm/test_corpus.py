"""Operators over a whole corpus against brute force: URL filters, phrases, tokenizer alignment."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.cases import DOCS, EXTRA, frame, odd_rows
from wordlode.llm import align, linkrank, phrases
from wordlode.llm.linkrank import Rule
from wordlode.llm.queries import URL_RULES

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# URL filters

PAGES = "page_id long, url string, html string, " + EXTRA.replace("host string", "host string, path string, rule string, verdict string")


def page_frame(spark, rows):
    names = [c.split() for c in PAGES.split(", ")][3:]
    extra = tuple("x" if kind == "string" else 7 for _, kind in names)
    return spark.createDataFrame([tuple(r) + extra for r in rows], PAGES)


def brute_split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return ascii_lower(host), re.match(r"[^?#]*", rest[len(host):]).group()


def brute_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), len(r.host), r.action == "block")) if fits else None


def brute_shares(pages, rules, links):
    """Both ranks of each host as the solution of linear equations."""
    hosts = sorted({brute_split(u)[0] for _, u, _ in pages} - {""} | {h for l in links for h in l})
    place = {h: i for i, h in enumerate(hosts)}
    result = []
    for action, pairs in (("allow", links), ("block", {(b, a): n for (a, b), n in links.items()})):
        seed, size = np.zeros(len(hosts)), np.zeros(len(hosts))
        for _, url, _ in pages:
            host, path = brute_split(url)
            if host:
                rule = brute_rule(host, path, rules)
                size[place[host]] += 1
                seed[place[host]] += rule is not None and rule.action == action
        seed = np.divide(seed, size, out=np.zeros_like(seed), where=size > 0)
        flow = np.zeros((len(hosts), len(hosts)))
        for (a, b), n in pairs.items():
            flow[place[b], place[a]] += n
        out = flow.sum(axis=0)
        flow = np.divide(flow, out, out=np.zeros_like(flow), where=out > 0)
        rank = np.linalg.solve(np.eye(len(hosts)) - 0.85 * flow, seed)
        result.append(rank / rank.sum() if rank.sum() else rank)
    return {h: (result[0][i], result[1][i]) for h, i in place.items()}


def random_pages(seed):
    rnd = random.Random(seed)
    hosts = [f"h{i}.{t}" for i in range(12) for t in ("org", "com", "net")] + ["example.org", "a.example.org", "org"]
    pages, links = [], Counter()
    for i in range(300):
        host = rnd.choice(hosts[: 6 if rnd.random() < 0.4 else None])
        path = rnd.choice(["/", "/es/1", "/en/12", "/fr/9", "/de/3", "", "/en/3"])
        html = []
        for _ in range(rnd.randint(0, 4)):
            other = rnd.choice(hosts)
            shown = other.upper() if rnd.random() < 0.2 else other
            html.append(rnd.choice([
                f"<a href='http://{shown}/x?y'>t</a>", f'<A class=b HREF="//{shown}#q">', f"<a title='z' href=https://{shown}>",
            ]))
            if other != host:
                links[host, other] += 1
        html += ["<a href='/local'>l</a>", "<link href='http://no.link/'>", "<a data-href='http://no.link/'>"]
        rnd.shuffle(html)
        pages.append((i, f"http://{host}{path}{rnd.choice(['', '?q=http://z.z/', '#t'])}", " ".join(html)))
    return pages, links


@pytest.mark.parametrize("block_links", [1_000_000, 2])
def test_link_ranks_equal_linear_equations(spark, monkeypatch, block_links):
    pages, links = random_pages(block_links)
    monkeypatch.setattr(linkrank.spread_from, "__defaults__", (block_links,))
    got = {r[0]: (r[1], r[2]) for r in linkrank.host_shares(page_frame(spark, pages), URL_RULES).collect()}
    want = brute_shares(pages, URL_RULES, links)
    assert got.keys() == want.keys()
    for host in want:
        assert got[host] == pytest.approx(want[host], abs=1e-7)


def test_urls_are_judged_by_rules_and_hosts(spark):
    pages, links = random_pages(1)
    odd = [(None, None, None), (900, "no host", "<a href='http://h1.net/'>"), (901, "", ""), (902, "HTTP://Org/", "x"),
           (903, "x://org", None), (904, "a://b.ORG:80/", ""), (905, "http://h1.com?a", "<a " * 20_000)]
    pages += odd + pages[:5] + odd[:2]
    found = linkrank.judge(page_frame(spark, pages), URL_RULES).select("row.page_id", "host", "path", "rule", "verdict")
    shares = brute_shares(pages, URL_RULES, links + _links_of(pages[300:]))
    bad = {h for h, (t, d) in shares.items() if d > t * (1 + 1e-9) and d * len(shares) > 1 + 1e-9}
    want = Counter()
    for page, url, _ in pages:
        host, path = brute_split(url)
        rule = brute_rule(host, path, URL_RULES)
        verdict = rule.action if rule else "block" if host in bad else "allow"
        want[page, host, path, rule.text if rule else None, verdict] += 1
    assert Counter(map(tuple, found.collect())) == want
    assert {"allow", "block"} <= {v for (_, _, _, rule, v) in want if rule is None}


def _links_of(pages):
    found = Counter()
    for _, url, html in pages:
        host = brute_split(url)[0]
        for other in re.findall(r"(?i)<a\s[^>]*?href=['\"]?(?:https?:)?//([^/?#\"'\s>]+)", html or ""):
            if host and ascii_lower(other) != host:
                found[host, ascii_lower(other)] += 1
    return found


def test_longest_rule_wins(spark):
    rules = [Rule("b.org", "/x", "allow"), Rule("org", "/xab", "block"), Rule("org", "/", "allow"), Rule("a.b.org", "", "block")]
    rows = [(1, "http://a.b.org/xab", ""), (2, "http://a.b.org/", ""), (3, "http://b.org/x", ""), (4, "http://c.org/xabc", "")]
    found = linkrank.judge(page_frame(spark, rows), rules).select("row.page_id", "rule").collect()
    # Three rules of seven signs fit the first page: the longest host decides.
    assert dict(map(tuple, found)) == {1: "a.b.org", 2: "a.b.org", 3: "b.org/x", 4: "org/xab"}


def test_url_filters_run_no_python_and_take_empty_tables(spark):
    pages, _ = random_pages(3)
    judged = linkrank.judge(page_frame(spark, pages), URL_RULES)
    links = linkrank.host_links(page_frame(spark, pages), "url", "html")
    for df in (judged, links):
        assert "Python" not in df._jdf.queryExecution().toString()
    empty = linkrank.judge(page_frame(spark, []), URL_RULES)
    assert empty.columns == judged.columns and empty.count() == 0


# Phrases


def brute_phrases(rows, support, top):
    counts, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    result = []
    for lang, found in counts.items():
        many = {p: a for p, a in found.items() if len(p) > 1 and a >= support}
        ranked = []
        for phrase, a in many.items():
            score, _, l, r = min(
                (2_000_000 * a // (found[phrase[:k]] + found[phrase[k:]]), k, found[phrase[:k]], found[phrase[k:]])
                for k in range(1, len(phrase))
            )
            covered = any(
                len(q) > len(phrase) and 100 * f >= 80 * a
                and any(q[i : i + len(phrase)] == phrase for i in range(len(q) - len(phrase) + 1))
                for q, f in many.items()
            )
            if not covered:
                ranked.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(result)


def phrase_rows(seed):
    rnd = random.Random(seed)
    words = ["The", "of", "a", "b", "cat", "sat", "é", "\x1cz", "日本", "x.y"]
    rows = []
    for i in range(150):
        some = [rnd.choice(words[: rnd.randint(2, len(words))]) for _ in range(rnd.randint(0, 40))]
        if i % 3 == 0:
            some[3:3] = ["New", "york", "city", "hall"]
        rows.append((rnd.choice([" ", "  ", "\t"]).join(some) + rnd.choice(["", ".", "\n", "\r\n x"]), rnd.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" . ", "fr"), ("long word " * 20_000, "en")] + rows[:20]


@pytest.mark.parametrize("shard_bytes", [phrases.SHARD_BYTES, 300, 1])
def test_phrases_equal_brute_force(spark, shard_bytes):
    rows = phrase_rows(5)
    extra = tuple("x" if c.split()[1] == "string" else 7 for c in EXTRA.split(", "))
    docs = spark.createDataFrame([r + extra for r in rows], "text string, lang string, " + EXTRA).repartition(3)
    for support, top in ((5, 40), (30, 2000)):
        found = phrases.mine(docs, support, top, shard_bytes=shard_bytes).collect()
        want = brute_phrases(rows, support, top)
        assert want and sorted(map(tuple, found)) == want


def test_shards_lower_the_support_by_their_share():
    rng = np.random.default_rng(0)
    numbers = rng.integers(0, 30, 4000).astype(np.int32)
    kept = {}
    for size, members, counts in phrases.levels(numbers, 30, lambda m, n: n >= 4):
        kept |= {tuple(m): c for m, c in zip(members.tolist(), counts.tolist())}
        assert members.shape[1] == size
    found = Counter()
    for size in range(1, 5):
        for i in range(len(numbers) - size + 1):
            if numbers[i : i + size].all():
                found[tuple(numbers[i : i + size].tolist())] += 1
    assert kept == {p: n for p, n in found.items() if n >= 4}


def test_exact_score_beyond_64_bits(spark):
    big = 4_000_000_000_000_000_000
    rows = [("en", 1, "a", big), ("en", 1, "b", big + 7), ("en", 2, "a b", big - 1), ("en", 1, "c", big), ("en", 2, "b c", 3),
            ("en", 3, "a b c", 2)]
    counts = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    got = {r["phrase"]: tuple(r)[3:] for r in phrases.scores(counts).collect()}
    assert got["a b"] == (big - 1, big, big + 7, 2_000_000 * (big - 1) // (2 * big + 7))
    # Both cuts of the last one are floored to 0: the smaller first part counts.
    assert got["a b c"] == (2, big, 3, 0)
    left = {r["phrase"] for r in phrases.outermost(phrases.scores(counts)).collect()}
    assert left == {"a b", "b c", "a b c"}


def test_a_task_of_many_shards_passes_on_one_table(spark):
    """With thresholds of one each shard finds every phrase; what leaves a task does not grow with its shards."""
    rnd = random.Random(8)
    rows = [("en", " ".join(rnd.choices("a b c d e f g h".split(), k=40)).encode()) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "text"])
    totals = {"en": sum(len(t) for _, t in rows)}

    class Held:
        value = []

    found = []
    for lengths in phrases.TOGETHER:
        out = list(phrases._mine(totals, 5, 100, *lengths, Held)(iter([batch])))
        pieces = [p for b in out for p in b.column("piece").to_pylist()]
        assert len(pieces) == len(set(pieces)) and pieces.count(-1) == 1
        below = sum(n for b in out for n in b.column("below").to_pylist())
        union = bytearray((1 << phrases.BITS) // 8)
        size = phrases.PIECE_BITS // 8
        given = (b.filter(pc.greater_equal(b.column("piece"), 0)).select(["piece", "at", "more"]) for b in out)
        for b in phrases._reaching(5 - below)(given):
            piece, marks = b.column("piece")[0].as_py(), b.column("bits")[0].as_py()
            union[piece * size : (piece + 1) * size] = marks
        found.append(bytes(union))
        Held.value = list(found)
    # Words and pairs are in the first union, and longer phrases in the second, mined only where the first has their pairs.
    want = brute_counts([t.decode() for _, t in rows])
    numbers = phrases.Numbers("en")
    for _, text in rows:
        numbers.add(text)
    hashes = numbers.hashes()
    for phrase, n in want.items():
        members = np.array([[numbers[w.encode()] for w in phrase]], np.int32)
        if n >= 5:
            assert phrases._marked(found, members, hashes)[0]
    assert sum(phrases._marked(found, np.array([[numbers[w.encode()] for w in p]], np.int32), hashes)[0] for p, n in want.items() if n < 5) < 20


def brute_counts(texts):
    counts = Counter()
    for text in texts:
        words = text.split()
        counts.update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    return counts


def test_bits_of_a_table_fill_up_and_stay(spark):
    table = np.zeros(phrases.PIECE_BITS, np.uint8)
    for _ in range(3):
        phrases._add(table, np.array([7, 9, 7]), np.array([100, 1, 1000]))
    assert table[7] == 255 and table[9] == 3 and table.sum() == 258
    for counts in (table, np.ones_like(table)):
        at, more = phrases._packed(counts)
        assert len(at) + len(more) <= len(counts)


def test_phrases_of_empty_tables(spark):
    for rows in ([], [(None, None)], [("one two", "en")]):
        found = phrases.mine(spark.createDataFrame(rows, "text string, lang string"))
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.count() == 0


# Alignment


def brute_alignment(texts):
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pair = align.encoders(BPE, PIECES)
    rows, counts = [], Counter()
    for text in texts:
        a = tokenizer.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        sides = [b"".join(t[i] for i in ids) for ids, t in ((a, pair.bytes_a), (b, pair.bytes_b))]
        if not text or any(s != (" " + text).encode() for s in sides):
            rows.append(([], [], [], ""))
            continue
        links, groups, i, j, x, y = [], [([], [])], 0, 0, 0, 0
        end_a, end_b = len(pair.bytes_a[a[0]]), len(pair.bytes_b[b[0]])
        groups[-1][0].append(a[0])
        groups[-1][1].append(b[0])
        while True:
            links.append((a[i], b[j]))
            at = min(end_a, end_b)
            step_a, step_b = end_a == at, end_b == at
            i, j = i + step_a, j + step_b
            if i == len(a):
                break
            if step_a and step_b:
                groups.append(([], []))
            if step_a:
                end_a += len(pair.bytes_a[a[i]])
                groups[-1][0].append(a[i])
            if step_b:
                end_b += len(pair.bytes_b[b[j]])
                groups[-1][1].append(b[j])
        shown = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        counts.update(links)
        rows.append((a, b, links, hashlib.sha256(shown.encode()).hexdigest(), len(groups)))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (len(r[0]), len(r[1]), r[4] if r[0] else 0, len(r[2]), sum(counts[l] == most[l[1]] for l in r[2]),
         sum(counts[l] for l in r[2]), r[3]) for r in rows
    ]


def alignment_rows():
    rnd = random.Random(2)
    alphabet = ["a", "The", " ", "  ", "\n", "é", "日本", "😀", "ß", "'s", "12", "\t", "\u3000", "\x00", ".", "-", "word", " of", "\xa0"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    texts += ["<|endoftext|> a <s> b </s><unk>", "<0x41>", "a ▁ b", "▁", " ", "\n", "a", " lead", "trail ", "e\u0301", "\ufffd", "\u200b"]
    rows = odd_rows() + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)]
    return rows + [(5000, " " * 120_000 + "x" + "\n" * 120_000, None, None, None)]


@pytest.mark.parametrize("sent, piece", [(align.SENT, align.PIECE), (0, 7), (align.SENT, 1)])
def test_alignment_equals_brute_force(spark, sent, piece):
    rows = alignment_rows()
    if piece == 1:
        rows = [r for r in rows if r[1] is None or len(r[1]) < 3000]
    found = align.alignment(frame(spark, rows), BPE, PIECES, sent=sent, piece=piece)
    want = Counter((r[0],) + w for r, w in zip(rows, brute_alignment([r[1] for r in rows])))
    assert Counter(map(tuple, found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    ).collect())) == want


def test_diagonals_cut_the_merge_into_equal_pieces():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (5, 3), (200, 1), (1, 200), (300, 280)):
        end = 2000
        a = np.append(np.sort(rng.choice(end - 1, n - 1, replace=False) + 1), end)
        b = np.append(np.sort(rng.choice(end - 1, m - 1, replace=False) + 1), end)
        order = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        diagonals = np.arange(n + m + 1)
        assert align.crossings(a, b, diagonals).tolist() == [sum(s == 0 for _, s in order[:d]) for d in diagonals]
        whole = align.merge(a, b, 10_000)
        ends = np.union1d(a, b)
        assert whole[0].tolist() == np.searchsorted(a, ends).tolist()
        assert whole[1].tolist() == np.searchsorted(b, ends).tolist()
        assert whole[2].tolist() == (np.isin(ends, a) & np.isin(ends, b)).tolist()
        for piece in (1, 2, 3, 17):
            for x, y in zip(align.merge(a, b, piece), whole):
                assert x.tolist() == y.tolist()


def test_alignment_of_an_empty_table(spark):
    found = align.alignment(spark.createDataFrame([], DOCS), BPE, PIECES)
    assert found.count() == 0
    nothing = align.alignment(frame(spark, [(1, None, None, None, None), (2, "", None, None, None)]), BPE, PIECES)
    assert sorted(map(tuple, nothing.collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
