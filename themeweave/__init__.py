"""Topic mining over large text corpora, written as Spark DataFrame operators."""
