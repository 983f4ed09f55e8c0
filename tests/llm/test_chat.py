import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import chat_format as C
from sluice.llm.queries import ORACLES, QUERIES, SPOKEN_MARKS
from tests import compare

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = st.sampled_from([*C.Template().controls, "[\\INST]", "<\\\\/s>", "[", "<", "\\", " ", "\n", "é", "x", "/s>"])
TEXTS = st.lists(MARKS, max_size=8).map("".join)
ROLES = st.one_of(st.sampled_from(["user", "assistant", "system"]), TEXTS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_comes_back(spark):
    seen = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.lists(st.tuples(ROLES, TEXTS), min_size=1, max_size=6))
    def gather(turns):
        seen.append(turns)

    gather()
    rows = [(c, t, role, text) for c, turns in enumerate(seen) for t, (role, text) in enumerate(turns)]
    formatted = C.format_conversations(spark.createDataFrame(rows, SCHEMA))
    back = {r.conv_id: [tuple(t) for t in r.turns] for r in formatted.select(
        "conv_id", C.read_turns(F.col("formatted")).alias("turns")).collect()}
    for r in C.conversation_digests(formatted).collect():
        turns = seen[r.conv_id]
        learned = "".join(text for role, text in turns if role == "assistant")
        assert back[r.conv_id] == turns
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha(learned))
        assert r.n_messages == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
    # The mask names just those bytes, and nothing of the template's.
    for r in formatted.collect():
        raw = r.formatted.encode()
        plain = C.Template().controls
        assert all(not any(c in raw[s.start:s.start + s.length].decode() for c in plain) for s in r.loss)
        assert r.formatted.count("</s>") == sum(m[0] == "assistant" and (i == 0 or seen[r.conv_id][i - 1][0] != "assistant")
                                                for i, m in enumerate(seen[r.conv_id]))


def test_many_turns(spark):
    n = 3 * C.STRETCH + 5
    rows = [(1, t, "user" if t % 3 else "assistant", f"é{t}") for t in range(n)]
    out = C.conversation_digests(C.format_conversations(spark.createDataFrame(rows, SCHEMA))).first()
    learned = "".join(f"é{t}" for t in range(0, n, 3))
    assert (out.n_turns, out.loss_sha256) == (n, sha(learned))


def test_odd_rows(spark):
    rows = [(1, 1, "user", None), (1, None, None, "first"), (None, 0, "assistant", "x" * 50_000), (2, 0, "user", "a"),
            (2, 0, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'c' AS formatted", "0 AS loss", "1 AS turns")
    out = {r.conv_id: r for r in C.conversation_digests(C.format_conversations(df)).collect()}
    assert out[1].turns_sha256 == sha("\nfirst\nuser\n\n")
    assert out[None].loss_chars == 50_000
    assert (out[2].n_turns, out[2].n_messages) == (2, 1)
    assert C.format_conversations(df.where("false")).count() == 0


def test_no_python_in_the_plan(spark, small):
    plan = QUERIES["op12_chat_formatting"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_query(spark, small):
    assert compare.check(spark, "op12_chat_formatting", small, QUERIES, ORACLES) is None
    own = QUERIES["op12_chat_formatting"](spark, small).where("conv_id = -1").first()
    assert own.loss_sha256 == sha(SPOKEN_MARKS)
