"""What Python workers hold: calls to the tokenizer are bounded, and a task gives back what it freed."""

import numpy as np
import pyarrow as pa

from soarcast.llm import ngram_join, tokens, workers
from soarcast.llm.text import slices


class _Watched:
    def __init__(self, tokenizer):
        self.tokenizer, self.most = tokenizer, 0

    def encode_batch_fast(self, strings, **kwargs):
        self.most = max(self.most, len(strings))
        return self.tokenizer.encode_batch_fast(strings, **kwargs)


def test_no_call_to_the_tokenizer_takes_a_whole_slice(monkeypatch):
    monkeypatch.setattr(tokens, "AT_ONCE", 64, raising=False)
    texts = [" ".join(f"w{i}x{j} é{i}{j}" for j in range(40)) for i in range(400)]
    (s,) = slices(pa.array(texts))
    code = tokens.Encoder(tokens.default_tokenizer())
    watched = code.tokenizer = _Watched(code.tokenizer)
    ids, at = code.encode(s)
    assert 0 < watched.most <= 64
    plain = [watched.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(plain, []) and np.diff(at).tolist() == list(map(len, plain))


def test_a_task_gives_back_when_it_ends(monkeypatch):
    calls = []
    monkeypatch.setattr(workers, "give_back", lambda: calls.append(1))
    run = workers.tidy(lambda batches: (b for b in batches))
    assert list(run(iter([1, 2, 3]))) == [1, 2, 3] and calls == [1]
    begun = run(iter([1, 2, 3]))
    assert next(begun) == 1
    begun.close()  # a task that is cut short
    assert calls == [1, 1]
    monkeypatch.undo()
    workers.give_back()


def _plain(code, texts):
    return [code.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_what_a_worker_remembers_is_narrow():
    """A worker's memory of pieces stays with it from task to task: hash, number, start and 16-bit ids, no spare room that is written."""
    code = tokens.Encoder(tokens.default_tokenizer())
    texts = [" ".join("".join(chr(97 + (i * 64 + j) // 26**k % 26) for k in range(4)) + "é" for j in range(64)) for i in range(400)]
    for lo in range(0, 400, 100):
        for s in slices(pa.array(texts[lo : lo + 100])):
            ids, at = code.encode(s)
            assert ids.dtype == np.uint32
            assert ids.tolist() == sum(_plain(code, texts[lo : lo + 100]), []) and np.diff(at).tolist() == list(map(len, _plain(code, texts[lo : lo + 100])))
    held = sum(x.nbytes for run in code.runs for x in run) + code.start[: code.known + 1].nbytes + code.ids[: code.used].nbytes
    assert code.known > 20000 and held <= 16 * code.known + 2 * code.used + 4
    (s,) = slices(pa.array(texts))  # all known by now
    known = code.known
    assert code.encode(s)[0].tolist() == sum(_plain(code, texts), []) and code.known == known


def test_long_pieces_do_not_grow_what_a_worker_remembers(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_IDS", 2000, raising=False)
    code = tokens.Encoder(tokens.default_tokenizer())
    texts = ["".join(chr(0x4E00 + (i * 997 + j * j) % 20000) for j in range(300)) for i in range(60)]  # no spaces: one piece each
    most = 0
    for t in texts:
        (s,) = slices(pa.array([t]))
        assert code.encode(s)[0].tolist() == _plain(code, [t])[0]
        most = max(most, code.used)
    assert most <= 2000 + max(len(x) for x in _plain(code, texts))


def test_whole_groups_come_in_tables_of_about_the_limit():
    """However large the batches are, also when a group runs across several of them."""
    for sizes in ([3] * 2000, [1, 700, 2, 2, 600, 1], [1000]):
        keys = np.repeat(np.arange(len(sizes)), sizes)
        t = pa.table({"cid": keys, "i": keys * 0, "row": np.arange(len(keys))})
        for at_once in (len(keys), 97):
            batches = [t.to_batches(max_chunksize=at_once)[0].slice(0, 0), *t.to_batches(max_chunksize=at_once)]
            got = list(ngram_join._whole_groups(iter(batches), ["cid", "i"], 64))
            assert pa.concat_tables(got).equals(t)
            first = [x["cid"][0].as_py() for x in got]
            assert len(set(first)) == len(got) and all(a["cid"][-1] != b["cid"][0] for a, b in zip(got, got[1:]))
            assert max(x.num_rows for x in got) <= 2 * 64 + max(sizes)
