"""Readers: files on any Hadoop file system, typed tables, and the adapter contract for CAD kernels."""
