"""aspectra: Spark-native opinion mining over review text.

DataFrame in, DataFrame out.  Typical use::

    from aspectra import annotate_corpus, extract_aspects, nb_train, polarity_training_set, predict
    model = nb_train(polarity_training_set(labelled_reviews))    # review_text, polarity
    flat = predict(reviews, model, flat=True)                      # review_id, review_text
"""

from .operators.annotate import annotate_corpus, split_sentences, tokenize
from .operators.bio import bio_tags
from .operators.evaluate import classification_report, roc_auc, seq_report
from .operators.polarity import lr_train, nb_train, polarity_score, polarity_training_set
from .operators.predict import predict, reject_reviews
from .operators.rules import all_rules, extract_aspects, head_children

__all__ = [
    "annotate_corpus", "split_sentences", "tokenize", "bio_tags", "classification_report", "roc_auc",
    "seq_report", "lr_train", "nb_train", "polarity_score", "polarity_training_set", "predict",
    "reject_reviews", "all_rules", "extract_aspects", "head_children",
]
