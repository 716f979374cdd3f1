import public_tokenizers

from rollbook.llm import QUERIES
from rollbook.llm.token_counts import BELOW, START, Pieces, Trie, piece_scores, token_counts


def brute(word, scores):
    byte = min(scores.values()) - BELOW
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        width = len(word[end - 1].encode())
        options = [(best[end - 1][0] + byte * width, best[end - 1][1] - width)]
        options += [(best[i][0] + scores[word[i:end]], best[i][1] - 1) for i in range(end) if word[i:end] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_documents_equal_word_by_word(spark, data, documents):
    scores = piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in documents.collect()}
    known = {}
    for r in QUERIES["op4_trie_token_counts"](spark, data).collect():
        words = [w.decode() for w in texts[r.doc_id].encode().split()]
        for w in words:
            if w not in known:
                known[w] = brute(START + w, scores)
        assert (r.n_words, r.n_tokens) == (len(words), sum(known[w] for w in words))


def test_shared_beginnings_are_scored_once():
    pieces = Pieces({"▁a": -1.0, "b": -1.0, "▁ab": -2.0, "c": -3.0})
    trie = Trie(pieces)
    trie.insert(sorted(["▁ab", "▁abc", "▁abcc", "▁b"]))
    # ties go to fewer tokens; nodes: ▁ a b c c, and b below ▁
    assert trie.counts == {"▁ab": 1, "▁abc": 2, "▁abcc": 3, "▁b": 4}
    assert trie.nodes == 6


def test_odd_rows_and_empty_table(odd):
    scores = {"▁": -1.0, "a": -2.0, "on": -1.5, "▁one": -1.0}
    out = token_counts(odd, scores).collect()
    assert len(out) == odd.count()
    for r in out:
        words = [w.decode() for w in (r.row.text or "").encode().split()]
        if sum(map(len, words)) < 50_000:
            assert (r.n_words, r.n_tokens) == (len(words), sum(brute(START + w, scores) for w in words))
    assert token_counts(odd.limit(0), scores).collect() == []
    assert token_counts(odd, {}).count() == odd.count()
