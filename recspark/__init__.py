"""Feature engineering for recommender systems as DataFrame-to-DataFrame operators."""
