"""Token counts under a unigram model, computed once per shared prefix of the distinct pre-tokens.

The distinct pre-tokens of a batch are walked as a trie, in sorted order: the
forward scores of a prefix are kept on a stack while its continuations are
visited, so words that share a prefix share its scores. The token count of the
best segmentation is stored at each word's end and summed per document.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from creditloom.llm.words import Words, text_slices
from creditloom.llm.workers import map_batches

SPACE = "▁"  # opens every pre-token
ZIPF_SHIFT = 2.7  # fixed value: the usual shift of Zipf's law
BYTE_PENALTY = 10.0  # a byte of a character outside the vocabulary costs this much more than the rarest piece

_models = {}


class UnigramVocabulary:
    """Pieces with log probabilities, by Zipf's law of their rank in the vocabulary file.

    The files come without unigram probabilities; their order is by falling
    frequency, from which the law gives them.
    """

    def __init__(self, pieces):
        self.score = {p: -math.log(rank + ZIPF_SHIFT) for rank, p in reversed(list(enumerate(pieces)))}
        self.longest = max(map(len, pieces), default=1)
        self.byte = -math.log(len(pieces) + ZIPF_SHIFT) - BYTE_PENALTY

    @classmethod
    def load(cls, path):
        """Once per worker: the pieces of a sentencepiece file, without control and byte pieces."""
        if path not in _models:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _models[path] = cls([
                model.id_to_piece(i) for i in range(model.get_piece_size())
                if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
            ])
        return _models[path]

    def counts(self, words):
        """Tokens in the best segmentation of each of ``words``, sorted and distinct.

        Of equally good segmentations the one with fewer tokens counts. A
        character outside the vocabulary is as many tokens as it has bytes.
        """
        score, longest = self.score, self.longest
        best, tokens, last, out = [0.0], [0], "", []
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del best[shared + 1:], tokens[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                top, few = -math.inf, 0
                for start in range(max(0, end - longest), end):
                    s = score.get(word[start:end])
                    if s is not None:
                        s += best[start]
                        if s > top or s == top and tokens[start] + 1 < few:
                            top, few = s, tokens[start] + 1
                if word[end - 1] not in score:
                    size = len(word[end - 1].encode("utf-8", "surrogatepass"))
                    s = best[end - 1] + size * self.byte
                    if s > top:
                        top, few = s, tokens[end - 1] + size
                best.append(top)
                tokens.append(few)
            out.append(tokens[len(word)])
            last = word
        return out


def count_tokens(df, vocabulary, doc="doc_id", text="text"):
    """Per row of ``df``: ``doc``, n_words and n_tokens (long), without a shuffle.

    Pre-tokens are the words of the whole text, ``[^\\x20\\x09-\\x0D]+``, each with
    a word mark before it. NULL and empty texts have no tokens. Repeated rows
    stay; other columns are ignored. ``vocabulary`` is the path of a
    sentencepiece file that executors can open.
    """
    source = df.select(F.col(f"`{doc}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def counted(batches):
        model = UnigramVocabulary.load(vocabulary)
        for batch in batches:
            ids = batch.column(0)
            for first, texts in text_slices(pc.fill_null(batch.column(1), "")):
                words = Words(texts)
                total = np.zeros(words.n_docs, np.int64)
                if len(words):
                    _, at, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
                    names = [SPACE + words.bytes_of(i).decode("utf-8", "replace") for i in at]
                    order = sorted(range(len(names)), key=names.__getitem__)
                    each = np.zeros(len(names), np.int64)
                    each[order] = model.counts([names[i] for i in order])
                    total = np.bincount(words.doc, weights=each[back], minlength=words.n_docs).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(texts)), pa.array(words.per_doc.astype(np.int64)), pa.array(total)],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return map_batches(source, counted, "doc_id bigint, n_words bigint, n_tokens bigint")
