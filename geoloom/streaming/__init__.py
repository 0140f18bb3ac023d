"""geoloom.streaming"""
