"""quillstream.plans"""
