import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F


from lodgespark.llm import line_templates as lt, queries
from tests.llm.helpers import EDGE_TEXTS, documents

SF = "/root/testdata/sf0.01"


def masked(text):
    out = []
    for line in (text or "").split("\n"):
        toks = [lt.WILD if any(c in "0123456789" for c in t) else t for t in line.replace("\t", " ").split()]
        out.append(" ".join(toks))
    return out


def brute(texts, min_docs):
    """Lines to drop per text, by the definitions: leaves, leading lines, agreement, support in different texts."""
    leaf = lambda line: (line.count(" "), tuple(line.split(" ")[:lt.DEPTH]))
    lines = [masked(t) for t in texts]
    docs_of_leaf, count = defaultdict(set), defaultdict(lambda: defaultdict(int))
    for t, ls in zip(texts, lines):
        for x in set(ls) - {""}:
            docs_of_leaf[leaf(x)].add(t)
            count[leaf(x)][x] += 1
    template = {}
    for k, known in count.items():
        if len(docs_of_leaf[k]) < min_docs:
            continue
        lead = []
        for place in range(k[0] + 1):
            votes = defaultdict(int)
            for x, n in known.items():
                votes[x.split(" ")[place]] += n
            n, tok = max((n, tok) for tok, n in votes.items())
            lead.append((tok, n / sum(votes.values())))
        for x in known:
            agree = sum(a == b for a, (b, _) in zip(x.split(" "), lead)) / len(lead)
            template[x] = (k, " ".join(b if s >= lt.FIXED else lt.WILD for b, s in lead) if agree >= lt.AGREE else x)
    support = defaultdict(set)
    for t, ls in zip(texts, lines):
        for x in ls:
            if x in template:
                support[template[x]].add(t)
    return [[i for i, x in enumerate(ls) if x in template and len(support[template[x]]) >= min_docs] for ls in lines]


def check(spark, texts, min_docs, docs=None):
    docs = documents(spark, texts) if docs is None else docs
    got = {r.doc_id: r for r in lt.drop_recurring_lines(docs, min_docs=min_docs).collect()}
    for i, (t, gone) in enumerate(zip(texts, brute(texts, min_docs))):
        r = got[i]
        keep = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        assert (r.clean_text, r.n_dropped) == (keep, len(gone)), (i, t)
        assert r.n_lines == sum(x != "" for x in masked(t))
    return got


def test_variable_fields_are_generalised(spark):
    names = "anna bert cleo dora emil finn gina hugo".split()
    texts = [f"Intro {n} alone here\nSomeone logged in as {n} from host {i}.{i} today\nunique body of {n} number" for i, n in enumerate(names)]
    texts += ["Someone logged in then wrote quite another thing today", "nothing shared"]
    got = check(spark, texts, 5)
    assert all("logged in" not in got[i].clean_text for i in range(8))
    assert "another thing" in got[8].clean_text


def test_every_family_of_a_leaf_has_its_template(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda k: "".join(letters[k // 26 ** j % 26] for j in range(3))
    first = [f"Posted by user {name(i)} in the forum about cars today" for i in range(24)]
    second = [f"Posted by user {name(100 + i)} through our mobile app last week" for i in range(20)]
    alike = [f"We say hello {name(200 + 9 * k + i)} {' '.join(name(900 + 7 * k + j) for j in range(6))}" for k in range(4) for i in range(9)]
    lone = ["Posted by user zoe with quite other words than these", "We say hello to no one else in this place"]
    lines = first + second + alike + lone
    got = {r.doc_id: r for r in lt.drop_recurring_lines(documents(spark, lines)).collect()}
    assert [got[i].n_dropped for i in range(len(lines))] == [1] * 80 + [0, 0]
    assert [got[i].clean_text for i in range(len(lines))] == [""] * 80 + lone


def test_random_logs_against_brute_force(spark):
    rng = random.Random(2)
    words = "alpha beta gamma delta".split()
    line = lambda: " ".join(rng.choice(words) if rng.random() < 0.8 else str(rng.randint(0, 99)) for _ in range(rng.randint(1, 6)))
    texts = ["\n".join(line() for _ in range(rng.randint(0, 6))) for _ in range(60)]
    check(spark, texts + texts[:3], 4)


def test_edges(spark):
    check(spark, EDGE_TEXTS, 2)
    assert lt.drop_recurring_lines(documents(spark, [])).count() == 0
    copies = ["one line of text here\nanother line of it"] * 30
    assert all(r.n_dropped == 0 for r in lt.drop_recurring_lines(documents(spark, copies)).collect())  # copies are one text
    ids = [None, None, 1, 1]
    rows = lt.drop_recurring_lines(documents(spark, ["a\nb x", "b y\na", "a", "a"], ids), min_docs=2).collect()
    assert len(rows) == 4


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op3_line_templates"](spark, SF).collect()}
    want = brute([r.text for r in docs], lt.MIN_DOCS)
    assert {r.doc_id: got[r.doc_id].n_dropped for r in docs} == {r.doc_id: len(w) for r, w in zip(docs, want)}
    assert sum(map(len, want)) > 0


def test_no_python_and_no_cross_join(spark):
    plan = lt.drop_recurring_lines(documents(spark, ["a\nb"]).select("doc_id", "text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_texts_are_masked_once(spark, monkeypatch):
    calls, mask = [], lt.masked_lines
    monkeypatch.setattr(lt, "masked_lines", lambda text: calls.append(1) or mask(text))
    rows = lt.drop_recurring_lines(documents(spark, ["a b\nc", "a b\nd", "a b\ne f"])).collect()
    assert len(calls) == 1 and {r.n_dropped for r in rows} == {1}


def test_masking_token_by_token(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1 9\n\t\x0b\x0c\r\xa0\u0663é$\\") for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, "", "1", " 1", "a\n\n2b c"]

    def by_token(text):
        lines = (text or "").split("\n")
        return [" ".join(lt.WILD if any(c in "0123456789" for c in t) else t for t in re.split(r"[\x20\t\x0b\x0c\r]+", x) if t) for x in lines]

    got = {r.doc_id: r.lines for r in documents(spark, texts).select("doc_id", lt.masked_lines(F.col("text")).alias("lines")).collect()}
    assert [got[i] for i in range(len(texts))] == [by_token(t) for t in texts]
    # linear, without recursion, however long a text without line ends or a token is
    long = ["word " * 300_000 + "end7", "x" * 1_000_000, "y" * 1_000_000 + "1 z"]
    got = {r.doc_id: r.lines for r in documents(spark, long).select("doc_id", lt.masked_lines(F.col("text")).alias("lines")).collect()}
    assert got[0] == ["word " * 300_000 + lt.WILD] and got[1] == long[1:2] and got[2] == [f"{lt.WILD} z"]


def by_rounds(texts, min_docs):
    """Lines to drop per text and the number of votes, by the definitions, one group of lines at a time."""
    lines = [masked(t) for t in texts]
    count = Counter(x for ls in lines for x in set(ls) - {""})
    texts_of, leaves = defaultdict(set), defaultdict(list)
    for t, ls in zip(texts, lines):
        for x in ls:
            texts_of[x].add(t)
    for x in count:
        leaves[x.count(" "), tuple(x.split(" ")[:lt.DEPTH])].append(x)
    recurs = lambda xs: len(set().union(*(texts_of[x] for x in xs))) >= min_docs
    groups, gone, votes = [g for g in leaves.values() if recurs(g)], set(), 0
    while groups:
        found, votes = [], votes + 1
        for group in groups:
            lead, template, total = [], defaultdict(list), sum(count[x] for x in group)
            for at in zip(*(x.split(" ") for x in group)):
                n = Counter()
                for x, token in zip(group, at):
                    n[token] += count[x]
                lead.append(max((m, token) for token, m in n.items()))
            agrees = {x for x in group if sum(a == b for a, (_, b) in zip(x.split(" "), lead)) / len(lead) >= lt.AGREE}
            shared = " ".join(b if m / total >= lt.FIXED else lt.WILD for m, b in lead)
            for x in group:
                template[shared if x in agrees else x].append(x)
            gone |= {x for xs in template.values() if recurs(xs) for x in xs}
            settled = agrees if agrees and recurs(template[shared]) else set()
            rest = [x for x in group if x not in settled]
            parts = {None: rest}
            if 2 * sum(count[x] for x in settled) < total:
                tokens = [Counter(at) for at in zip(*(x.split(" ") for x in rest))]
                places = [(len(c), k) for k, c in enumerate(tokens) if 1 < len(c) < len(rest)]
                parts = defaultdict(list)
                for x in rest if places else []:
                    token = x.split(" ")[min(places)[1]]
                    parts[token if tokens[min(places)[1]][token] > 1 else None].append(x)
            found += [p for p in parts.values() if len(p) > 1 and recurs(p)]
        groups = found
    return [[i for i, x in enumerate(ls) if x in gone] for ls in lines], votes


def test_many_votes_against_the_definitions(spark):
    rng = random.Random(11)
    pick = lambda k, f, i: rng.choice(["p", "q", f"f{f}", f"f{f}", f"u{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}"])
    texts = [" ".join(["x y z", *(pick(k, i % 3, i) for k in range(6))]) for i in range(90)]
    texts += [f"see the list {' '.join(rng.choice('abc') for _ in range(4))}\nx y z" for _ in range(40)]
    want, votes = by_rounds(texts + texts[:9], 3)
    assert votes >= 4 and 0 < sum(map(len, want)) < sum(len(t.split("\n")) for t in texts)
    got = {r.doc_id: r for r in lt.drop_recurring_lines(documents(spark, texts + texts[:9])).collect()}
    kept = ["\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone) for t, gone in zip(texts + texts[:9], want)]
    assert [(got[i].n_dropped, got[i].clean_text) for i in range(len(kept))] == [(len(w), k) for w, k in zip(want, kept)]


def test_a_line_is_taken_apart_again_only_where_its_group_halved(spark, monkeypatch):
    # a leaf of which each vote splits off two lines: taking all apart each time grows with the square of its lines
    pairs, own = 5, 12
    letters = "abcdefghijkl"
    texts = [" ".join(["We say this", *("odd" if i // 2 == k else "even" for k in range(pairs)), *(f"{letters[i]}{letters[k]}" for k in range(own))])
             for i in range(2 * pairs + 2)]
    assert by_rounds(texts, 3)[1] == pairs
    made, store = [], lt.stored

    def generated(node):
        """Rows that the Generate nodes of a plan make, each place in the plan for itself."""
        below = [node.children().apply(i) for i in range(node.children().size())]
        mine = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, node).count() if node.nodeName() == "Generate" else 0
        return mine + sum(map(generated, below))

    def counting(df, name):
        if name not in ("masked", "occurrences", "lines"):
            made.append(generated(df._jdf.queryExecution().optimizedPlan()))
        return store(df, name)

    monkeypatch.setattr(lt, "stored", counting)
    rows = lt.drop_recurring_lines(documents(spark, texts)).collect()
    tokens = sum(len(t.split(" ")) for t in texts)
    assert tokens <= sum(made) <= 2 * tokens, (made, tokens)
    assert [r.n_dropped for r in rows] == [0] * len(texts)
