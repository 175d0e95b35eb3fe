"""Words of language identification: runs of letters, found fast."""

import random
import time
from itertools import groupby

from stipend.llm import langid


def brute(text):
    return ["".join(run) for letters, run in groupby(text, str.isalpha) if letters]


def test_words_are_runs_of_letters():
    rng = random.Random(4)
    signs = "ab é½Ⅷ²_9٣ \n-東一\u0301𐄇𝟗𐐨"
    for n in range(300):
        text = "".join(rng.choices(signs, k=n % 40))
        assert langid.words_of(text) == brute(text)


def test_letters_are_not_compared_with_every_number_sign():
    text = "plain words of a long text " * 20_000

    def seconds(find):
        spent = []
        for _ in range(3):
            start = time.process_time()
            find(text)
            spent.append(time.process_time() - start)
        return min(spent)

    assert seconds(langid.words_of) < 6 * seconds(langid._ALNUM.findall)
    # One sign does not slow down the other words.
    text += "½x"
    assert seconds(langid.words_of) < 9 * seconds(langid._ALNUM.findall)
