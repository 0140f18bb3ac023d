"""geoloom.operators"""
