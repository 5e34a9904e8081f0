"""Licence scan, BPE, PII and line rules against brute force and round trips."""

import hashlib
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from millrace.llm import bpe, licences, lines, pii

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---- licence scan


def test_base_places_match_brute_force(table):
    rng = random.Random(4)
    parts = ["CC", "by", "all", "rights", "reserved", "general", "public", "license", "x", "-", ". ", "Ö", "7"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 80))), "a") for i in range(200)]
    got = {r.doc_id: r for r in licences.scan_licences(table(rows)).collect()}
    for i, text, _ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text))
        places = [(k, label) for phrase, label in licences.BASE.items() for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
        row = got[i]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert row.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(row.base_labels.split(",")) - {""} <= set(row.labels.split(","))


def test_matching_statistics_match_brute_force():
    rng = random.Random(5)
    for _ in range(30):
        sequences = [[rng.randint(0, 3) for _ in range(rng.randint(1, 12))] for _ in range(4)]
        automaton = licences.SuffixAutomaton(sequences)
        runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a, len(s) + 1)}
        text = [rng.randint(0, 4) for _ in range(60)]
        state = length = 0
        for i, token in enumerate(text):
            while state and token not in automaton.next[state]:
                state = automaton.link[state]
                length = automaton.length[state]
            if token in automaton.next[state]:
                state, length = automaton.next[state][token], length + 1
            want = max(n for n in range(i + 2) if tuple(text[i + 1 - n:i + 1]) in runs)
            assert length == want
            if length:
                ends = {(k, e) for k, s in enumerate(sequences) for e in range(len(s) + 1) if e >= length and s[e - length:e] == text[i + 1 - length:i + 1]}
                assert automaton.ends[state] == ends


def test_template_spans_bridge_small_edits(table):
    text = "Start. Permission is hereby granted, free of charge, to any person getting a copy of this software and its associated documentation files, to deal in the software without restriction. End."
    row = licences.scan_licences(table([(1, text, "a"), (2, "permission is granted to the software", "a")])).collect()
    assert row[0].labels == "mit" and 0.75 <= row[0].score < 1 and row[0].spans[0].first_word == 1
    assert row[1].labels == "" and row[1].score == 0


def test_long_text_is_read_in_blocks(monkeypatch):
    text = (b"some words, CC-BY all rights reserved " * 200)
    whole = licences.Scanner(licences.TEMPLATES, licences.BASE).read(licences.word_blocks(text))
    monkeypatch.setattr(licences, "BLOCK_BYTES", 37)
    assert licences.Scanner(licences.TEMPLATES, licences.BASE).read(licences.word_blocks(text)) == whole


def test_licences_odd_rows(odd, none):
    rows = licences.scan_licences(odd).collect()
    assert len(rows) == odd.count() and all(r.n_words == 0 for r in rows if r.doc_id in (2, 3, 6))
    assert licences.scan_licences(none).count() == 0


# ---- BPE


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as file:
        return bpe.Codec(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encoding(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.transducer.ranks, special_tokens={})


def test_ids_match_the_library(coder, encoding):
    rng = random.Random(6)
    letters = "abcdefgh eiou  \n\t'stvelm0123456789.,!?-éüßñ漢字😀AB%$　\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 3000, "ab" * 2000, "the" * 1500, " " * 4000 + "x", "-" * 3000, "ö" * 2000, "ThanThe" * 400]
    for text in texts:
        packed = coder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == encoding.encode_ordinary(text)
        assert "".join(coder.decode(packed)) == text


def test_caches_may_be_emptied_at_any_time(monkeypatch, coder, encoding):
    for name in ("MAX_STATES", "MAX_PAIRS"):
        monkeypatch.setattr(bpe, name, 3)
    small = bpe.Codec.__new__(bpe.Codec)
    small.__dict__ |= coder.__dict__
    small.transducer = bpe.Transducer(coder.transducer.ranks)
    small.pieces = bpe.Pieces(small.transducer, 3)
    text = "reinterpretations of unquestionably antidisestablishmentarian words " * 3
    assert np.frombuffer(small.encode(text), "<u4").tolist() == encoding.encode_ordinary(text)


def test_blocks_do_not_change_ids(monkeypatch, coder, encoding):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 11)
    monkeypatch.setattr(bpe, "BLOCK_TOKENS", 2)
    text = "It's  a text, 12 of\n\n  spaces and 漢字 words don't   break here  "
    packed = coder.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == encoding.encode_ordinary(text)
    assert "".join(coder.decode(packed)) == text


def test_utf8_tail_over_any_cut():
    data = "aé漢😀z".encode() + b"\xff\xe2\x82"
    for cut in range(len(data) + 1):
        for other in range(cut, len(data) + 1):
            tail = bpe.Utf8Tail()
            made = tail.feed(data[:cut]) + tail.feed(data[cut:other]) + tail.feed(data[other:]) + tail.close()
            assert made == data.decode("utf-8", "replace")


def test_bpe_odd_rows(odd, none):
    made = bpe.encode_documents(odd, RANKS, public_tokenizers.PATTERN, with_ids=True)
    rows, texts = made.collect(), odd.collect()
    assert sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in texts)
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (2, 3))
    back = {(r.doc_id, r.text) for r in bpe.decode_documents(made, RANKS, public_tokenizers.PATTERN).collect()}
    assert back == {(r.doc_id, r.text or "") for r in texts}
    assert bpe.encode_documents(none, RANKS, public_tokenizers.PATTERN).count() == 0


# ---- PII


def test_permutation_is_one_to_one_and_turns_back():
    f = pii.Feistel(b"key")
    for size in (1, 2, 7, 1000, 4097):
        made = [f.permute(i, size, b"t") for i in range(size)]
        assert sorted(made) == list(range(size))
        assert [f.permute(v, size, b"t", inverse=True) for v in made] == list(range(size))


TEXT = ("Mail und.34@mail7.example.com or +1 (017) 555-7713; cards 4111 1111 1111 1111, 4111111111111111 and not 4111111111111112; host 129.38.82.176 "
        "but not 329.38.82.176; born 1999-02-28, 29.02.2000, not 30.02.2000; IBAN GB82 WEST 1234 5698 7654 32; SSN 123-45-6789, not 000-45-6789; "
        "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" end")


def test_pseudonyms_keep_format_and_link_equal_values():
    f = pii.Feistel(b"key")
    made, counts = pii.pseudonymise(TEXT, f)
    assert counts == {"email": 1, "secret": 1, "iban": 1, "ipv6": 0, "ipv4": 1, "date": 2, "phone": 1, "ssn": 1, "card": 2}
    kinds = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d+\.\d+\.\d+\.\d+", "ip", re.sub("[0-9a-f]{40}", "hex", t))))
    assert re.sub(r"\d", "9", kinds(made)) == re.sub(r"\d", "9", kinds(TEXT))
    first, second = re.search(r"cards ([\d ]+), (\d+)", made).groups()
    assert first.replace(" ", "") == second != "4111111111111111" and pii.luhn_sum(second) == 0
    for left in ("4111111111111112", "329.38.82.176", "30.02.2000", "000-45-6789"):
        assert left in made
    assert pii.pseudonymise(made, f, inverse=True)[0] == TEXT
    assert pii.pseudonymise(TEXT, pii.Feistel(b"other"))[0] != made


MORE = ("Write jörg@exämple.de, ..x@y.org and a.b@c.de; call 020 7946 0958, +44 20 7946 0958 or (017) 555-7713; hosts 2001:db8::8a2e:370:7334, FE80:0:0:0:1:2:3:4B, "
        "not 12:34:56 nor std::a1b nor version 1.2.3.4 nor v1.2.3.4; on 3.4.2021, 13.4.2021, 12/31/2020, 04/05/2020 but not 31/31/2020 or 30.2.2021")


def test_more_formats_go_and_come_back():
    f = pii.Feistel(b"key")
    made, counts = pii.pseudonymise(MORE, f)
    assert counts == {"email": 3, "secret": 0, "iban": 0, "ipv6": 2, "ipv4": 0, "date": 4, "phone": 3, "ssn": 0, "card": 0}
    assert len(made) == len(MORE) and pii.pseudonymise(made, f, inverse=True)[0] == MORE
    for left in ("12:34:56", "std::a1b", "version 1.2.3.4", "v1.2.3.4", "31/31/2020", "30.2.2021", "@", "+44 "):
        assert left in made


def plain_scan(text, f):
    """Every type's own pattern at every place, one after another."""
    swap, out, at, n = (lambda v, size, tweak: f.permute(v, size, tweak)), [], 0, 0
    kinds = [(re.compile(p), new) for p, new in pii.TYPES.values()]
    while at < len(text):
        found, made = next(((m, new(m[0], swap)) for pattern, new in kinds if (m := pattern.match(text, at))), (None, None))
        out.append(text[at] if found is None else found[0] if made is None else made)
        n += made is not None
        at += len(found[0]) if found else 1
    return "".join(out), n


def test_pseudonyms_against_a_plain_scan(spark):
    f = pii.Feistel(b"k")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = {r.doc_id: r for r in pii.pseudonymise_documents(docs, b"k").collect()}
    found = 0
    for r in docs.collect():
        lines = [plain_scan(line, f) for line in (r.text or "").split("\n")]
        assert (made[r.doc_id].text, made[r.doc_id].n_found) == ("\n".join(t for t, _ in lines), sum(n for _, n in lines))
        found += made[r.doc_id].n_found
    assert found > 20
    assert plain_scan(TEXT, f)[0] == pii.pseudonymise(TEXT, f)[0] and plain_scan(MORE, f)[0] == pii.pseudonymise(MORE, f)[0]


@pytest.mark.parametrize("text", ["a" * 1_000_000 + "1", "a." * 500_000 + "1", "漢" * 300_000 + "@1", "a1@" * 300_000, "x@" + "b." * 300_000 + "1", "token=" + "aB3" * 300_000,
                                  "a" * 300_000 + "@b.de", "1:" * 300_000, "1 " * 300_000 + "1.2.", "password " * 50_000])
def test_long_unbroken_text_is_linear(text):
    start = time.process_time()
    f = pii.Feistel(b"key")
    made, _ = pii.pseudonymise(text, f)
    assert time.process_time() - start < 20 and len(made) == len(text)
    assert pii.pseudonymise(made, f, inverse=True)[0] == text


def test_no_key_is_part_of_the_code(spark):
    key = pii.session_key(spark)
    assert len(key) == 64 and pii.session_key(spark) == key
    spark.conf.set(pii.KEY_CONF, "mine")
    try:
        assert pii.session_key(spark) == b"mine"
    finally:
        spark.conf.unset(pii.KEY_CONF)


def test_pii_odd_rows(odd, none, table):
    made = pii.pseudonymise_documents(odd, b"k")
    assert sorted((r.doc_id or 0, r.text) for r in made.collect()) == sorted((r.doc_id or 0, r.text or "") for r in odd.collect())
    assert pii.pseudonymise_documents(none, b"k").count() == 0
    there = pii.pseudonymise_documents(table([(1, TEXT, "a"), (2, TEXT, "b")]), b"k")
    assert there.select("text").distinct().count() == 1
    assert {r.text for r in pii.pseudonymise_documents(there, b"k", inverse=True).collect()} == {TEXT}


# ---- line rules


def test_repeated_words_match_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        want = {i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(5)}
        assert lines.repeated_words(words) == len(want)


def test_repeated_words_with_a_large_vocabulary():
    words = [f"w{i}" for i in range(9000)] + [f"w{i}" for i in range(100, 110)]
    assert lines.repeated_words(words) == 20


def test_lines_are_judged_one_by_one():
    good = "This is a proper sentence of many words, and it ends well."
    text = f"{good}\nHome | News | About\nWe use cookie banners here.\nBUY THIS THING NOW BUY IT.\n\n{good}\nAnd a second proper sentence that is long enough to count."
    made = lines.judge(text)
    assert made["clean_text"].split("\n") == [good, "", "And a second proper sentence that is long enough to count."]
    assert made["n_dup_lines"] == 1 and made["failed_menu"] == made["failed_boilerplate"] == made["failed_shouting"] == made["failed_repeated"] == 1
    assert not made["kept"]
    assert lines.judge(good)["kept"]


def test_lines_odd_rows(odd, none):
    rows = lines.line_rules(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (2, 3, 6))
    assert lines.line_rules(none).count() == 0
