"""URL rules, token counts, byte-level BPE: against plain Python on small tables."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ratewise.llm import bpe_codec, token_counts, url_rules
from ratewise.llm.common import safe_pieces, safe_segments

ODD = ["", None, "one", " a  b\n\n c\t d ", "x" * 3000, "tab\t\n next\r\n line   end   ", "it's <|endoftext|> we'll\n",
       "naïve café ünïcode 日本語テキスト", "a\u00a0 b\u2003\n c", "😀 😀😀 \n😀"] + ["word %d, more-text" % i * 40 for i in range(5)]


def brute_rule(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for rule, verdict in rules:
        h, p = rule.split("/", 1)
        if (h == "" or host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    best = max(fits, default=None)
    return host, path, best[1] if best else None, best[2] if best else default


URLS = ["http://A.Example.NET/en/x?y", "https://example.net/en", "http://example.net:80/en/", "ftp://net/", "http://xnet/", "no scheme", None, "",
        "http://a.b.example.org/fr/1#t", "http://example.org?fr/", "http://m.example.com/de/", "http://notexample.com/de/", "x://y://z/",
        "http://org./fr/", "http://a.org/fr", "http:///p", "http://é.example.net/en/", "HTTP://W.EXAMPLE.COM/de/q"]
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"),
         ("example.org/fr/", "block"), ("b.example.org/fr/", "allow"), ("example.com/d", "allow")]


@pytest.mark.parametrize("ranges", [1, 7])
def test_url_rules_match_brute_force(spark, ranges):
    rows = [(i if i % 9 else None, u, "clash", "clash") for i, u in enumerate(URLS * 3 + ["http://hot.example.net/en/1"] * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = url_rules.judge_urls(pages, url_rules.rule_table(spark, RULES), ranges=ranges).collect()
    want = [(i, *brute_rule(u, RULES)) for i, u, *_ in rows]
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_url_rules_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = url_rules.rule_table(spark, RULES)
    assert url_rules.judge_urls(none, rules).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_rules.judge_urls(one, rules.where("false")).collect()[0].verdict == "allow"


def docs_of(spark, texts):
    return spark.createDataFrame([(i if i != 3 else None, t, "x", 5) for i, t in enumerate(texts)],
                                 "doc_id long, text string, n_tokens string, ids int")


def test_safe_cuts_keep_the_text():
    for t in ODD:
        t = t or ""
        assert "".join(safe_pieces(t)) == t
        assert "".join(safe_segments(t, 5)) == t


@pytest.mark.parametrize("vocab", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, vocab):
    import public_tokenizers as P
    if vocab.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=P.path(vocab))
        count = lambda t: len(sp.encode(t))
    else:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(P.path(vocab))
        tok.no_truncation()
        tok.no_padding()
        count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    texts = ODD + ["long text, " * 200_000]
    got = token_counts.token_counts(docs_of(spark, texts), vocab).collect()
    assert len(got) == len(texts)
    want = {(i if i != 3 else None): (len((t or "").encode()), count(t or "")) for i, t in enumerate(texts)}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_known_pieces_are_dropped_without_changing_counts(monkeypatch):
    lib = token_counts._Library("byte_bpe_50k.json")
    texts = [f"word{i} and{i % 7} more" for i in range(500)]
    want = lib.count(texts)
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 10)
    monkeypatch.setattr(token_counts, "BATCH_CHARS", 200)
    assert token_counts._Library("byte_bpe_50k.json").count(texts * 2) == want * 2


def test_bpe_round_trip(spark):
    import public_tokenizers as P
    import tiktoken
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=bpe_codec._codec("byte_bpe_50k.tiktoken")._mergeable_ranks, special_tokens={})
    texts = ODD + ["long text; it's\n" * 30_000]
    got = {r.doc_id: r for r in bpe_codec.round_trip(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        r = got[i if i != 3 else None]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_codec.round_trip(empty).count() == 0
    assert token_counts.token_counts(empty).count() == 0
    nul = bpe_codec.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")).select(F.length("decoded")).first()[0]
    assert nul == 0


@pytest.mark.parametrize("blank", [" ", "\n", "\t", " \n", "　", "\x85"])
def test_bpe_of_long_blank_runs(blank):
    """Runs that the library still takes give its ids; a run of a million characters is taken too."""
    import tiktoken
    enc = bpe_codec._codec("byte_bpe_50k.tiktoken")
    assert isinstance(enc, tiktoken.Encoding)
    run = blank * (20_000 // len(blank))
    for text in (run, f"a{run}b", f"a{run}", f"{run}b", f"it's{run}1{run}{run}.", f"a{run} b{run[:9990]}c", f"x{run}\x1cy"):
        assert bpe_codec._encode_text(enc, text) == enc.encode_ordinary(text)
    huge = "begin" + blank * (1_000_000 // len(blank)) + "end"
    ids = bpe_codec._encode_text(enc, huge)
    assert enc.decode_bytes(ids) == huge.encode()
    n = len(run) - 1  # a run of an even and of an odd number of blanks ends alike
    assert ids[-2:] == enc.encode_ordinary(f"a{run}end")[-2:] and n
