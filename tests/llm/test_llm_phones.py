"""National phone numbers at the ends of sentences, prefixed and in other groupings."""

from parcelstream.llm import pii

from test_llm_text_ops import rows_of

PHONES = ["555-123-4567", "(555) 123-4567", "1-555-123-4567", "1 (555) 123-4567", "030 1234567",
          "0171/1234567", "06 12 34 56 78", "(020) 7946 0958", "555-1234", "5551234567", "01234 567890"]
ENDS = [".", "!", ", or write", " today", "; bye", ".\nNext", " - or not", "", ") or so"]
OTHERS = ["order 555-123-4567.", "serial 030 1234567.", "it was 1234567890 then.", "call on 2024-01-15.",
          "call me 14.07.2021 please", "see 1999-2003.", "the 12345678901234567890 x",
          "call from host 192.168.10.25."]


def phones(spark, texts):
    found = pii.find(rows_of(spark, texts)).collect()
    rank = pii.KINDS.index("phone")
    return {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.found if s.rank == rank] for r in found}


def test_national_numbers(spark):
    cases = [(cue, p, end) for cue in ("call ", "please phone: ", "my tel ") for p in PHONES for end in ENDS]
    got = phones(spark, ["".join(c) for c in cases])
    assert [(c, got[i]) for i, c in enumerate(cases) if got[i] != [c[1]]] == []


def test_several_numbers_in_one_text(spark):
    text = "call 555-123-4567 555-123-4568. Or phone 030 1234567."
    assert phones(spark, [text])[0] == ["555-123-4567", "555-123-4568", "030 1234567"]


def test_look_alikes(spark):
    assert phones(spark, OTHERS) == {i: [] for i in range(len(OTHERS))}


def test_sentence_final_numbers_are_redacted(spark):
    out = pii.redact(rows_of(spark, ["call 555-123-4567.", "phone 1-555-123-4567."])).collect()
    assert {r.doc_id: r.text for r in out} == {0: "call [PHONE].", 1: "phone [PHONE]."}
