"""quillstream.sources"""
