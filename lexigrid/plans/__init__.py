from lexigrid.plans.chains import cooccurrence_of_corpus, scores_of_corpus

__all__ = ["cooccurrence_of_corpus", "scores_of_corpus"]
