"""quillstream.operators"""
