"""Readers: manifests, label files, image folders, vector files, sample tables."""
