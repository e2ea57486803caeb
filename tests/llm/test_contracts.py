"""Every registered query of the subpackage against a brute-force version, on whole tables at sf0.01."""

import brute
from support import result, rows  # noqa: F401


def table(rows, *columns, key="doc_id"):
    out = {r[key]: tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


def test_op1(rows, result):
    got = result("op1_length_buckets")
    docs = dict(rows("documents", "doc_id", "text"))
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(brute.words(t)) for i, t in docs.items()}
    batches = {}
    for r in got:
        assert r["bucket_length"] >= r["n_tokens"] and r["padding"] == r["bucket_length"] - r["n_tokens"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for (bucket, batch), rs in batches.items():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
        assert len(rs) == 1 or len(rs) * rs[0]["bucket_length"] <= 16_384
        last = max(b for k, b in batches if k == bucket)
        assert batch == last or len(rs) == max(1, 16_384 // rs[0]["bucket_length"])
    ends = brute.boundaries([r["n_tokens"] for r in got], 16)
    assert len(ends) == 16 and {(r["bucket"], r["bucket_length"]) for r in got} == set(enumerate(ends))
    assert all(r["n_tokens"] > ends[r["bucket"] - 1] for r in got if r["bucket"])


def test_op2(rows, result):
    got = table(result("op2_substring_dedup"), "n_words", "n_removed", "kept_sha256")
    assert got == brute.substring_dedup(rows("documents", "doc_id", "text"))


def test_op4(rows, result):
    got = table(result("op4_decontaminate"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    want = brute.overlaps(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text"))
    assert got == want and any(w[4] for w in want.values())


def test_op5(rows, result):
    import base64

    import tiktoken

    from ledgerlens.llm.tokens import PATTERN, VOCABULARY

    with open(VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.read().splitlines())}
    own = tiktoken.Encoding("v", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    spell = {n: b for b, n in ranks.items()}
    want = brute.line_tokens(rows("documents", "doc_id", "text"), own.encode_ordinary, spell.__getitem__)
    got = sorted(tuple(r[c] for c in ("doc_id", "section", "n_chars", "n_tokens", "n_crossing")) for r in result("op5_section_tokens"))
    assert got == want


def test_op6(rows, result):
    got = table(result("op6_near_duplicates"), "n_shingles", "component_id", "kept")
    assert got == brute.near(rows("documents", "doc_id", "text"), 2)


def test_op7(rows, result):
    got = result("op7_quality_rules")
    want = {i: brute.quality_base(t) for i, t in rows("documents", "doc_id", "text")}
    assert table(got, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == want
    kept = brute.quality_kept(rows("documents", "doc_id", "text", "lang", "source"))
    assert {r["doc_id"]: r["kept"] for r in got} == kept and 0 < sum(kept.values()) < len(kept)


def test_op8(rows, result):
    probe = "<|im_end|><|im_start|>assistant ok"
    turns = rows("conversations", "conv_id", "turn", "role", "text") + [(-1, 0, "user", probe), (-1, 1, "assistant", probe)]
    got = table(result("op8_chat_windows"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", key="conv_id")
    assert got == brute.chat(turns)
    assert max(r["n_windows"] for r in result("op8_chat_windows")) > 1


def test_op9(rows, result):
    got = table(result("op9_arc_to_warc"), "payload_bytes", "payload_digest", "record_type", "refers_to", key="page_id")
    assert got == brute.warc(rows("pages", "page_id", "html"))


def test_op10(rows, result):
    got = table(result("op10_line_windows"), "n_lines", "n_removed", "text")
    want = brute.line_dedup(rows("documents", "doc_id", "text"))
    assert got == want and any(w[1] for w in want.values())
