"""Models: MLlib random forest, isolation forest, approximate one-class SVM, SMOTE."""
