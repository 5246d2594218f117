"""End-to-end plans over dataset folders."""
