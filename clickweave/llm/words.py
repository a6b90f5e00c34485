r"""Words of letters and digits, `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower-cased."""

from __future__ import annotations

import numpy as np

from clickweave.llm.common import Hashes, Words

# Fixed: the words' hashes are those of this seed wherever they are compared.
HASHES = Hashes(303)


def word_bytes() -> tuple[np.ndarray, np.ndarray]:
    """For each byte, whether words have it, and its lower case.

    All bytes of characters beyond ASCII are 128 or more, so words can be found bytewise.
    """
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    is_word = np.zeros(256, bool)
    is_word[48:58] = is_word[97:123] = is_word[128:] = True
    return is_word[fold], fold


WORDS = Words(*word_bytes(), HASHES)
