"""quillstream.functions"""
