"""Small documents with copies, near copies, repeats, odd and missing texts."""

import random


def corpus(seed=1, n=60, vocabulary=400, words=(20, 120)):
    rng = random.Random(seed)
    lexicon = ["".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    sentence = lambda k: " ".join(rng.choice(lexicon) for _ in range(k))
    passage, out = sentence(50), []
    for i in range(n):
        text = sentence(rng.randint(*words))
        kind = i % 6
        if kind == 1 and out:
            text = out[rng.randrange(len(out))][1] or ""
        if kind == 2 and out:                                # near copy
            w = (out[rng.randrange(len(out))][1] or "").split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = rng.choice(lexicon)
            text = " ".join(w)
        if kind == 3:
            text = f"{text}\n{passage} {sentence(5)}"
        if kind == 4:
            text = "Ab ab. " * rng.randint(1, 60)
        out.append((i, text))
    return out + [(n, None), (n + 1, ""), (n + 2, "one"), (n + 3, "ONE"), (n + 4, " \t\n"), (n + 5, "é" * 300), (n + 6, "x" * 5000),
                  (n + 7, "a b c d"), (n + 8, "A b c d"), (n + 9, " ".join(["long"] * 4000))]
