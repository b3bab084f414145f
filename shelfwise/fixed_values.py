"""Fixed values that must equal the original pipeline's for identical output.

Everything here is data, not logic: URI prefixes, property codes, the cold-start
phrase, the pandas missing-value tokens and the eight prompt runs (template and
label-word mapping as published with the original experiments).
"""

from __future__ import annotations

# --- FIXED VALUES (must match the original pipeline) ----------------------

# Knowledge-graph resource prefix and the markers stripped from values.
RESOURCE_PREFIX = "http://dbpedia.org/resource/"
CATEGORY_MARKER = "Category:"
GENRE_SUFFIX = "_(genre)"

# Property codes of the triple file; every other code is ignored.
PROP_AUTHOR = 2
PROP_SERIES = 3
PROP_GENRE = 4
PROP_PUBLISHER = 5
PROP_SUBJECT = 7

# Cold-start rewrite applied when a user has no liked genres.
COLD_START_PHRASE = "User likes the book genres *user_genres*"
COLD_START_REPLACEMENT = "We don't know which genres the user likes"

# Strings pandas.read_csv turns into missing values by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Train/dev split parameters and text budget.
DEV_FRACTION = 0.2
SPLIT_SEED = 42
MAX_TEXT_TOKENS = 128

# Prompt runs: (run_name, kind, template, label-word mapping).
PROMPT_RUNS = (
    (
        "flan-t5-base-dbbook-prompt-1",
        "text",
        "We want to recommend a book. The candidate book is described in the following: *item_text*. The user likes the genres *user_genres*, it is good to recommend to him the candidate book?",
        "{0:'No', 1:'Yes'}",
    ),
    (
        "flan-t5-base-dbbook-prompt-2",
        "text",
        "We want to recommend a book to user_*user_id*. The candidate book is described in the following: *item_text*. The user likes the genres *user_genres*, it is good to recommend to him the candidate book?",
        "{0:'No', 1:'Yes'}",
    ),
    (
        "flan-t5-base-dbbook-prompt-3",
        "text",
        "We want to recommend a book to user_*user_id*. The candidate book item_*item_id* is described in the following: *item_text*. The user likes the genres *user_genres*, it is good to recommend to him the candidate book?",
        "{0:'No', 1:'Yes'}",
    ),
    (
        "flan-t5-base-dbbook-prompt-4",
        "text",
        "We will describe a book and the reading tastes of the reader, we want to know if such book is a good fit for the reader. *item_text*. User likes the book genres: *user_genres*, will he appreciate the book?",
        "{0:'No', 1:'Yes'}",
    ),
    (
        "flan-t5-base-dbbook-prompt-5",
        "text",
        "We will describe a book and the reading tastes of the reader user_*user_id*, we want to know if such book is a good fit for the reader. *item_text*. User likes the book genres: *user_genres*, will he appreciate the book?",
        "{0:'No', 1:'Yes'}",
    ),
    (
        "flan-t5-base-dbbook-prompt-6",
        "text",
        "We will describe the book item_*item_id* and the reading tastes of the reader user_*user_id*, we want to know if such book is a good fit for the reader. *item_text*. User likes the book genres: *user_genres*, will he appreciate the book?",
        "{0:'No', 1:'Yes'}",
    ),
    (
        "flan-t5-base-dbbook-structured-prompt-automatic",
        "structured",
        "as *item_genre* like *item_author* ##uter *item_subject* where *user_genres* happened",
        "{0: 'detest', 1: 'love'}",
    ),
    (
        "flan-t5-base-dbbook-structured-prompt-manual",
        "structured",
        "We want to recommend a book. The candidate book is written by *item_author*, published by *item_publisher*, it belongs to the series *item_series*. The user likes the genres *user_genres*, the candidate book is about *item_subject* and has genre *item_genre*, it is good to recommend to him the candidate book?",
        "{0:'No', 1:'Yes'}",
    ),
)

# Placeholder order of the two renderers (replacement is sequential).
TEXT_PLACEHOLDERS = ("user_id", "item_id", "item_text")
STRUCTURED_PLACEHOLDERS = (
    "user_id", "item_id", "item_genre", "item_author", "item_series",
    "item_publisher", "item_subject",
)

# Decoded-generation markers cleaned before answer comparison.
PAD_MARKER = "<pad>"
EOS_MARKER = "</s>"

# --- end of fixed values ---------------------------------------------------
