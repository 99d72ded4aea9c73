"""lotledger.operators"""
