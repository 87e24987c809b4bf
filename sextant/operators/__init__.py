"""DataFrame operators: statistics, imputation, groups, encoders, folds,
augmentation, evaluation, profiles, models."""
