"""quillstream: text-corpus analytics expressed as Spark DataFrame plans."""
