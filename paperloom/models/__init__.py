"""Topic, word, document and layout models on MLlib."""
