"""quillstream.streaming"""
