"""Registered queries: each operator on the test tables, whole tables throughout.

Roles: domain texts are documents labelled quality 1, background texts all other
documents; the vocabulary is the benchmark's words of five or more letters, the
gazetteer the words of part names, stop words the fifty words in most documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wordlode.functions import text as T
from wordlode.functions.rows import explode_rows
from wordlode.operators import (
    cells, classify, counts, discover, expand, factor, graph, match, pairs as similar, probable, terms, textrank, vectors, walks,
)
from wordlode.plans.mine import (
    MiningConfig, dictionary, mine_vocabulary, remove_stop_words, screen, sentence_texts,
)
from wordlode.plans.daily import add_day, run_day
from wordlode.profiles import LATIN
from wordlode.session import bounded_list, cut_lineage, shared_path, spread
from wordlode.sources.tables import scan, scan_partition, write_partition

DAY, DAY_BEFORE = "20240102", "20240101"


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return scan(spark, f"{sf}/{name}.parquet", *columns)


def tokens_of(text: str | Column = "text", lower: bool = True) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return T.words(column, LATIN.separator, lower)


def documents(spark, sf, *columns):
    return spread(table(spark, sf, "documents", *(columns or ("doc_id", "text"))))


def is_domain(spark, sf):
    return table(spark, sf, "labels").where("quality = 1").select("doc_id").distinct()


def domain(spark, sf):
    return documents(spark, sf).join(is_domain(spark, sf), "doc_id", "left_semi")


def background(spark, sf):
    return documents(spark, sf).join(is_domain(spark, sf), "doc_id", "left_anti")


def vocabulary(spark, sf):
    words = explode_rows(table(spark, sf, "benchmark", "text"), tokens_of(), "key")
    return words.where(F.length("key") >= 5).distinct()


def gazetteer(spark, sf):
    return explode_rows(table(spark, sf, "part", "p_name"), tokens_of("p_name"), "key").distinct()


def common_words(spark, sf, n):
    """The words that are in most documents."""
    seen = explode_rows(documents(spark, sf, "text"), F.array_distinct(tokens_of()), "txt")
    return (
        seen.groupBy("txt").agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "txt").limit(n).select("txt")
    )


def stop_words(spark, sf):
    return common_words(spark, sf, 50)


def stop_list(spark, sf):
    return bounded_list(stop_words(spark, sf), "txt", 50)


def candidates(spark, sf):
    words = explode_rows(documents(spark, sf, "text"), tokens_of(), "word").distinct()
    # Written first, so that rules run once per word: Spark would move them before distinct.
    return cut_lineage(words)


def sentence_rows(df: DataFrame, *keys: str) -> DataFrame:
    split = T.sentences(F.col("text"), LATIN.sentence_delimiters)
    return explode_rows(df, split, "sentence", *keys, pos="sent_id")


def sentence_tokens(text: str = "text", lower: bool = True) -> Column:
    return F.transform(
        T.sentences(F.col(text), LATIN.sentence_delimiters), lambda s: tokens_of(s, lower)
    )


def joined(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name), digits).alias(name)


# Scans, text functions, rules

def scan_project(spark, sf):
    return table(spark, sf, "documents", "doc_id", "lang", "source")


def partition_scan(spark, sf):
    path = shared_path(spark, "by-day")
    columns = ("doc_id", F.length("text").alias("n"))
    write_partition(background(spark, sf).select(*columns), path, DAY_BEFORE)
    write_partition(domain(spark, sf).select(*columns), path, DAY)
    return scan_partition(spark, path, DAY, "doc_id", "n")


def decode_text(spark, sf):
    # A stray byte before, an unfinished character after the text.
    raw = F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"), F.unhex(F.lit("E4BD")))
    return documents(spark, sf).select("doc_id", T.valid_text(raw).alias("text"))


def seed_match_filter(spark, sf):
    counted = match.match_count(
        documents(spark, sf).select("doc_id", F.lower("text").alias("text")),
        F.col("text"), vocabulary(spark, sf),
    )
    return counted.where("match_cnt > 5").select("doc_id", "match_cnt")


def term_matches(spark, sf):
    found = match.term_matches(
        spread(table(spark, sf, "pages", "page_id", "html")), ["page_id"], F.lower("html"),
        vocabulary(spark, sf),
    )
    return found.groupBy("page_id", "term").agg(
        F.count("*").alias("n"), F.min("pos").cast("long").alias("first_pos")
    )


def clean_chain(spark, sf):
    return documents(spark, sf).select("doc_id", T.clean(F.col("text"), LATIN.cleaning).alias("text"))


def lexical_rules(spark, sf):
    return candidates(spark, sf).where(T.acceptable(F.col("word"), LATIN.word_rules))


def charset_filter(spark, sf):
    pieces = cut_lineage(
        explode_rows(documents(spark, sf, "text"), F.split("text", "[ \n]+"), "word").distinct()
    )
    return pieces.where(T.in_charset(F.col("word")))


def sentence_split(spark, sf):
    return sentence_rows(documents(spark, sf), "doc_id")


def tokenize(spark, sf):
    return explode_rows(documents(spark, sf), tokens_of(), "word", "doc_id", pos="pos")


def stop_word_filter(spark, sf):
    df = documents(spark, sf).select("doc_id", tokens_of().alias("tokens"))
    kept = remove_stop_words(df, "tokens", stop_words(spark, sf))
    return kept.select("doc_id", joined(F.col("tokens")).alias("tokens"))


def token_views(spark, sf):
    views = textrank.token_views(F.col("s"), stop_list(spark, sf))
    return documents(spark, sf).select("doc_id", sentence_tokens().alias("s")).select(
        "doc_id",
        *[joined(F.transform(view, joined)).alias(name) for name, view in views.items()],
    )


def allowed_views(spark, sf):
    """Token views with an allow list: the 400 most widespread words, without the stop words among them."""
    allowed = bounded_list(common_words(spark, sf, 400), "txt", 400)
    views = textrank.token_views(F.col("s"), stop_list(spark, sf), allowed)
    return documents(spark, sf).select("doc_id", sentence_tokens().alias("s")).select(
        "doc_id",
        *[F.array_join(F.transform(views[name], joined), " ").alias(name) for name in ("no_stop_words", "all_filters")],
    )


def dictionary_segment(spark, sf):
    terms = vocabulary(spark, sf).union(gazetteer(spark, sf))
    cut = match.segment(
        documents(spark, sf), ["doc_id"], F.lower("text"), terms, LATIN.separator, single=True
    )
    return explode_rows(cut, F.col("tokens"), "token", "doc_id").groupBy("doc_id", "token").agg(F.count("*").alias("n"))


def probable_segment(spark, sf):
    """Words of documents cut into dictionary words by their frequency in the benchmark and part names."""
    words = explode_rows(table(spark, sf, "benchmark", "text"), tokens_of(), "key").union(
        explode_rows(table(spark, sf, "part", "p_name"), tokens_of("p_name"), "key")
    )
    known = words.groupBy("key").agg(F.count("*").alias("n"))
    cut = probable.segment_probable(documents(spark, sf), ["doc_id"], F.lower("text"), known, LATIN.separator)
    return explode_rows(cut, F.col("tokens"), "token", "doc_id").groupBy("doc_id", "token").agg(F.count("*").alias("n"))


# Counts and statistics

def word_freq(spark, sf):
    return counts.word_frequency(documents(spark, sf, "text"), tokens_of())


def term_counts(spark, sf):
    rows = sentence_rows(spread(table(spark, sf, "conversations")), "conv_id", "turn")
    keys = ("conv_id", "turn", "sent_id")
    return explode_rows(rows, tokens_of("sentence"), "word", *keys).groupBy(*keys, "word").agg(
        F.count("*").alias("n")
    )


def pair_pmi(spark, sf):
    runs = discover.count_runs(documents(spark, sf, "text"), F.lower("text"), LATIN.separator)
    return discover.pair_statistics(cut_lineage(runs)).select(
        "a", "b", F.col("n_ab").alias("n"), rounded("pmi")
    )


def new_words(spark, sf):
    return discover.discover_words(
        documents(spark, sf, "text"), F.lower("text"), LATIN.separator
    )


def corpus_frequencies(spark, sf):
    return [counts.word_frequency(df, tokens_of()) for df in (domain(spark, sf), background(spark, sf))]


def aligned_vocabulary(spark, sf):
    return counts.align(*corpus_frequencies(spark, sf))


def scaled_background(spark, sf):
    return counts.scale_background(counts.align(*corpus_frequencies(spark, sf))).select(
        "word", rounded("background")
    )


def _ratio(spark, sf, missing):
    return counts.smoothed_ratio(*corpus_frequencies(spark, sf), missing)


def smoothed_ratio_zero(spark, sf):
    return _ratio(spark, sf, "zero").select("word", rounded("score"))


def smoothed_ratio_null(spark, sf):
    return _ratio(spark, sf, "null").select("word", rounded("score"))


def specific_words(spark, sf):
    """Flagship: the words most specific to the domain, by the whole slice."""
    clean = [
        df.select(T.clean(F.col("text"), LATIN.cleaning).alias("text"))
        for df in (domain(spark, sf), background(spark, sf))
    ]
    scored = counts.smoothed_ratio(*[counts.word_frequency(df, tokens_of()) for df in clean])
    good = scored.where(T.acceptable(F.col("word"), LATIN.word_rules))
    return (
        good.orderBy(F.round("score", 9).desc(), "word").limit(100)
        .select("word", F.col("domain").cast("long").alias("freq"), rounded("score"))
    )


def keyword_budget(spark, sf):
    return counts.keyword_budget(domain(spark, sf), background(spark, sf))


def phrase_count(spark, sf):
    phrases = {"n_the": "the", "n_de": "de ", "n_on_the": "on the", "n_haha": "haha"}
    return documents(spark, sf).select(
        "doc_id", *[T.phrase_count(F.lower("text"), F.lit(p)).alias(n) for n, p in phrases.items()]
    )


# Graphs

def window_pairs(spark, sf):
    rows = explode_rows(documents(spark, sf), sentence_tokens(), "tokens")
    pairs = explode_rows(rows, graph.window_pairs(F.col("tokens"), 3), "p")
    return pairs.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(
        F.count("*").alias("n")
    )


def cooccur_graph(spark, sf):
    rows = explode_rows(documents(spark, sf), sentence_tokens(), "tokens")
    vertices = candidates(spark, sf).where(T.acceptable(F.col("word"), LATIN.word_rules))
    return graph.cooccurrence(rows, "tokens", 3, vertices=vertices)


def pagerank_corpus(spark, sf):
    rows = explode_rows(documents(spark, sf), sentence_tokens(), "tokens")
    ranks = textrank.corpus_words(rows, "tokens", 2)
    return ranks.select("word", rounded("weight", 9))


def pagerank_doc(spark, sf):
    views = textrank.token_views(F.col("s"), stop_list(spark, sf))
    ranked = textrank.analyse(views, vertex_source="all_filters", edge_source="no_filter")
    turns = spread(table(spark, sf, "conversations", "conv_id", "turn", "text"))
    tokens = turns.select("conv_id", "turn", sentence_tokens().alias("s"))
    return explode_rows(tokens, ranked, "k", "conv_id", "turn").select("conv_id", "turn", "k.word", F.round("k.weight", 9).alias("weight"))


def _keyword_frame(spark, sf, num, min_len, lower):
    df = documents(spark, sf).select("doc_id", "text", sentence_tokens(lower=lower).alias("s"))
    views = textrank.token_views(F.col("s"), stop_list(spark, sf))
    return df.withColumn("keywords", textrank.analyse(views, num=num, min_len=min_len))


def doc_keywords(spark, sf):
    df = _keyword_frame(spark, sf, 6, 2, True)
    return explode_rows(df, F.col("keywords"), "k", "doc_id", pos="pos").select("doc_id", "pos", "k.word", F.round("k.weight", 9).alias("weight"))


def keyphrases(spark, sf):
    phrases = textrank.keyphrases(F.col("text"), F.col("s"), F.col("keywords.word"), LATIN.joiner)
    return explode_rows(_keyword_frame(spark, sf, 12, 1, False), phrases, "phrase", "doc_id")


def sentence_similarity(spark, sf):
    tokens = documents(spark, sf).select("doc_id", sentence_tokens().alias("s"))
    followers = F.zip_with(
        F.slice("s", 1, F.size("s") - 1), F.slice("s", 2, F.size("s") - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    pairs = explode_rows(
        tokens.where(F.size("s") > 1), followers, "p", "doc_id", pos="sent_id"
    )
    a, b = F.col("p.a"), F.col("p.b")
    return pairs.select(
        "doc_id", "sent_id",
        F.size(F.array_union(a, b)).alias("n_union"),
        F.size(F.array_intersect(a, b)).alias("n_shared"),
        F.round(T.sentence_similarity(a, b), 6).alias("similarity"),
    )


def sentence_rank(spark, sf):
    ranked = textrank.ranked_sentences(sentence_tokens())
    return explode_rows(documents(spark, sf), ranked, "r", "doc_id").select(
        "doc_id", F.col("r.index").alias("sent_id"), F.round("r.strength", 6).alias("strength"),
        F.round("r.weight", 9).alias("weight"),
    )


def sentence_partners(spark, sf):
    found = textrank.sentence_partners(sentence_tokens(), 3)
    return explode_rows(documents(spark, sf), found, "p", "doc_id").select(
        "doc_id", F.col("p.index").alias("sent_id"), "p.rank", "p.partner",
        F.round("p.similarity", 6).alias("similarity"),
    )


def sentence_pairs(spark, sf):
    """Sentences of a document with a similarity of 1.2 or more, equal ones as one."""
    rows = sentence_rows(documents(spark, sf), "doc_id").select("doc_id", "sent_id", tokens_of("sentence").alias("tokens"))
    found = similar.similar_pairs(rows, "tokens", "sent_id", 1.2, ("doc_id",))
    return found.withColumn("similarity", F.round("similarity", 6))


def keyword_contrast(spark, sf):
    stop = stop_words(spark, sf)
    texts = []
    for df in (domain(spark, sf), background(spark, sf)):
        rows = explode_rows(df, sentence_tokens(), "tokens", "doc_id")
        texts.append(remove_stop_words(rows, "tokens", stop))
    budget = counts.keyword_budget(domain(spark, sf), background(spark, sf)).first()
    return textrank.keyword_contrast(*texts, budget=budget).select("word", rounded("weight", 9))


def word_graph(spark, sf):
    """Words that follow each other in a sentence of a document, weighted by how often; both directions."""
    rows = explode_rows(documents(spark, sf), sentence_tokens(), "tokens")
    pairs = explode_rows(rows, graph.window_pairs(F.col("tokens"), 2), "p")
    weighted = pairs.groupBy(F.least("p.a", "p.b").alias("a"), F.greatest("p.a", "p.b").alias("b")).agg(
        F.count("*").alias("weight")
    )
    back = weighted.where("a <> b").select(F.col("b").alias("src"), F.col("a").alias("dst"), "weight")
    return weighted.select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight").unionByName(back)


def random_walks(spark, sf):
    return walks.random_walks(cut_lineage(word_graph(spark, sf)), walks=1, length=5, p=1.25, q=0.8, seed=7)


def term_ids(spark, sf):
    return terms.term_ids(candidates(spark, sf))


# Vectors and expansion

def vector_table(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("word"),
        F.col("embedding").cast("array<double>").alias("vector"), "label",
    )


def by_label(spark, sf, label):
    return vector_table(spark, sf).where(F.col("label") == label).select("word")


def vector_topk(spark, sf):
    v = cut_lineage(vector_table(spark, sf))
    return vectors.nearest(v, v, 10).select("query", "word", rounded("sim"))


def centroid_shift(spark, sf):
    v = cut_lineage(vector_table(spark, sf))
    center = vectors.mean_vector(v, by_label(spark, sf, 0))
    negative = vectors.mean_vector(v, by_label(spark, sf, 1))
    return vectors.nearest(v, vectors.shifted(v, center, negative), 5).select(
        "query", "word", rounded("sim")
    )


def index_recall(spark, sf):
    """How many of the ten exact neighbours of each vector lie in the cells looked into."""
    v = cut_lineage(vector_table(spark, sf))
    index = cells.build_index(v, cells=16)
    found = cells.nearest_in_cells(index, v, 10, probes=12)
    return cells.recall(found, vectors.nearest(v, v, 10)).select(
        "expected", (F.col("recall") >= 0.9).alias("enough")
    )


EXPANSION = dict(min_sim=0.3, plain_floor=0.3)
# Few neighbours and low floors: words are reached over several levels.
DEEP = dict(min_sim=0.02, plain_floor=0.02, alpha=0.05, k=4)


def _plain(word):
    # The word rule of this table: no 7 in the name.
    return ~word.contains("7")


def expand_scored(spark, sf):
    found = expand.expand(
        cut_lineage(vector_table(spark, sf)), by_label(spark, sf, 0), accept=_plain, **EXPANSION
    )
    return found.select("word", "depth", rounded("score"))


def _deep(spark, sf, mode):
    found = expand.expand(
        cut_lineage(vector_table(spark, sf)), by_label(spark, sf, 0), accept=_plain, mode=mode, **DEEP
    )
    return found.select("word", "depth", rounded("score"))


def expand_deep(spark, sf):
    return _deep(spark, sf, "level")


def expand_fixpoint(spark, sf):
    return _deep(spark, sf, "fixpoint")


def expand_members(spark, sf):
    return expand.expand_members(
        cut_lineage(vector_table(spark, sf)), by_label(spark, sf, 0), accept=_plain, **EXPANSION
    )


def final_score(spark, sf):
    v = cut_lineage(vector_table(spark, sf))
    cluster = expand.expand(v, by_label(spark, sf, 0), accept=_plain, **EXPANSION)
    specificity = v.where("label <> 3").select("word", ((F.col("label") + 1) / 10.0).alias("score"))
    scored = expand.final_score(specificity, cluster, power=2.0, how="left")
    return scored.select("word", rounded("score"))


# Exclusion

def exclude_known(spark, sf):
    return match.exclude_containing(candidates(spark, sf), vocabulary(spark, sf))


def exclude_gazetteer(spark, sf):
    return match.exclude_containing(candidates(spark, sf), gazetteer(spark, sf))


def exclude_prefix(spark, sf):
    return match.exclude_prefixes(candidates(spark, sf), vocabulary(spark, sf))


# Trained vectors, classes of texts

def _domain_tokens(spark, sf):
    return cut_lineage(domain(spark, sf).select(tokens_of().alias("tokens")))


def _described(df):
    # What training fixes whatever its random start: the words and the length of finite vectors.
    return df.select("word", F.size("vector").alias("n_dims"), F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x)
    ).alias("broken"))


def word_vectors(spark, sf):
    return _described(vectors.train_vectors(_domain_tokens(spark, sf), "tokens", 16, 5, 5))


def seed_vectors(spark, sf):
    trained = cut_lineage(vectors.train_vectors(_domain_tokens(spark, sf), "tokens", 16, 5, 5))
    return _described(vectors.seeds_with_vectors(vocabulary(spark, sf), trained))


def information_cells(spark, sf):
    found = factor.information_cells(_domain_tokens(spark, sf), "tokens", window=5, min_count=5)
    return found.select("a", "b", "n", rounded("value"))


def factor_vectors(spark, sf):
    return factor.factor_vectors(_domain_tokens(spark, sf), "tokens", 16, window=5, min_count=5, tolerance=1e-4)


def text_vectors(spark, sf):
    """Texts by the fixed table of vectors, which words take theirs from by a hash."""
    numbered = cut_lineage(vector_table(spark, sf).select(F.col("word").cast("long").alias("place"), "vector"))
    words = candidates(spark, sf).withColumn("place", F.pmod(walks.draw(F.col("word")), F.lit(numbered.count())))
    known = words.join(numbered, "place").select("word", "vector")
    docs = documents(spark, sf).select("doc_id", tokens_of().alias("tokens"))
    found = classify.text_vectors(docs, "tokens", known, classify.rare_weights(docs, "tokens"))
    return explode_rows(found, F.col("vector"), "x", "doc_id", pos="dim").select("doc_id", "dim", F.round("x", 6).alias("x"))


def is_held_out(doc_id="doc_id"):
    """A fourth of the documents, by a hash of their id."""
    return F.pmod(walks.draw(F.col(doc_id)), F.lit(4)) == 0


def text_classes(spark, sf):
    """Documents classed as domain or not by vectors of their words, learned from three fourths of the labels."""
    tokens = cut_lineage(documents(spark, sf).select("doc_id", tokens_of().alias("tokens")))
    known = cut_lineage(factor.factor_vectors(tokens, "tokens", 32, window=5, min_count=5, tolerance=1e-3))
    found = classify.text_vectors(tokens, "tokens", known, classify.rare_weights(tokens, "tokens"))
    rows = cut_lineage(found.drop("tokens"))
    labels = table(spark, sf, "labels").where(~is_held_out()).select("doc_id", F.col("quality").alias("label"))
    model = classify.train(rows.join(labels, "doc_id"), "vector", "label")
    return classify.predict(rows, model).select("doc_id", is_held_out().alias("held_out"), "predicted", "margin")


# The whole job

MINING = MiningConfig(profile=LATIN, vector_size=16, min_sim=0.6, lower=True)


def _corpora(spark, sf):
    return domain(spark, sf), background(spark, sf)


def mined_terms(spark, sf):
    """The dictionary that the whole job cuts its texts with, from the stages before it."""
    texts = [sentence_texts(df, MINING) for df in _corpora(spark, sf)]
    budget = counts.keyword_budget(*_corpora(spark, sf)).first()
    found = dictionary(
        *texts, vocabulary(spark, sf), gazetteer(spark, sf), stop_words(spark, sf), budget, MINING
    )
    return found.terms.select("key", "origin")


def mined_screen(spark, sf):
    """The stages after training, from a fixed table of vectors.

    Words are ids between two letters. Known words are ends and continuations of them, places
    beginnings, each of all ids of a label.
    """
    v = cut_lineage(vector_table(spark, sf).withColumn("word", F.concat(F.lit("a"), "word", F.lit("b"))))
    specificity = v.select("word", ((F.col("label") + 1) / 10.0).alias("score"))
    known = v.where("label = 1").select(
        F.explode(F.array(F.substr("word", F.lit(2)), F.concat("word", F.lit("c")))).alias("key")
    )
    places = v.where("label = 2").select(F.rtrim("word", F.lit("b")).alias("key"))
    seeds = v.where("label = 0").select("word")
    found = screen(
        specificity, v.select("word", "vector"), seeds, known, places,
        accept=_plain, top=100, neighbours=200, **EXPANSION,
    )
    return found.select("word", rounded("score"))


def mined_vocabulary(spark, sf):
    return mine_vocabulary(
        *_corpora(spark, sf), vocabulary(spark, sf), gazetteer(spark, sf), stop_words(spark, sf), MINING
    )


def daily_words(spark, sf):
    """The job on two days, the second one run twice: what its result table holds then."""
    folder = shared_path(spark, "daily")
    source, state, back, output = (f"{folder}/{name}" for name in ("source", "state", "background", "output"))
    days = domain(spark, sf).select("doc_id", "text")
    counted = days.withColumn("match_cnt", F.length("text") / 100)
    write_partition(counted.where("doc_id % 2 = 0"), source, DAY_BEFORE)
    write_partition(counted.where("doc_id % 2 = 1"), source, DAY)
    add_day(background(spark, sf).select("text"), back, DAY_BEFORE, MINING)
    for day in (DAY_BEFORE, DAY, DAY):
        run_day(spark, source, state, back, output, MINING, day)
    return scan(spark, output).select("run_date", "word", rounded("score"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_project, partition_scan, decode_text, seed_match_filter, term_matches, clean_chain,
        lexical_rules, charset_filter, sentence_split, tokenize, stop_word_filter, token_views, allowed_views,
        dictionary_segment, probable_segment, word_freq, term_counts, pair_pmi, new_words, aligned_vocabulary,
        scaled_background, smoothed_ratio_zero, smoothed_ratio_null, specific_words,
        keyword_budget, phrase_count, window_pairs, cooccur_graph, pagerank_corpus, pagerank_doc,
        doc_keywords, keyphrases, sentence_similarity, sentence_partners, sentence_rank,
        sentence_pairs, keyword_contrast, random_walks, term_ids,
        vector_topk, centroid_shift, expand_scored, expand_deep, expand_fixpoint,
        expand_members, final_score, exclude_known,
        exclude_gazetteer, exclude_prefix, word_vectors, seed_vectors, information_cells, factor_vectors,
        text_vectors, text_classes, index_recall, mined_terms, mined_screen,
        mined_vocabulary, daily_words,
    )
}
