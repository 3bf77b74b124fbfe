"""Retrieval and banding lose nothing that comparing all pairs would find."""

import os

import pytest

from pagliaio.llm.addresses import LIMIT, parse_addresses, same_address_pairs, street_cost
from pagliaio.llm.lookalikes import look_alike_pairs, one_form
from pagliaio.tables import current_state, load

pytestmark = pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")


def test_all_addresses_of_a_block_compared(spark):
    rows = current_state(load(spark, "/root/testdata/sf0.01", "listings"), ["comune", "address_raw", "zona_raw", "title", "caption"])
    blocks = {}
    for r in parse_addresses(rows).collect():
        blocks.setdefault((r.place.comune, r.place.number, r.place.suffix), []).append((r.rec, r.place.kind, tuple(r.place.words)))
    want = set()
    for block in blocks.values():
        for i, (a, ka, wa) in enumerate(block):
            for b, kb, wb in block[i + 1 :]:
                if (ka, wa) == (kb, wb) or street_cost(ka, wa, kb, wb) <= LIMIT:
                    want.add((min(a, b), max(a, b)))
    got = {(r.rec_a, r.rec_b) for r in same_address_pairs(rows).collect()}
    assert len(want) > 300 and got == want


def test_all_texts_compared(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text and r.text.strip()]
    forms = [(i, t, one_form(t)) for i, t in rows]
    want = {(min(a[0], b[0]), max(a[0], b[0])) for k, a in enumerate(forms) for b in forms[k + 1 :] if a[2] == b[2] and a[1] != b[1]}
    assert want and {(r.doc_a, r.doc_b) for r in look_alike_pairs(docs).collect()} == want
