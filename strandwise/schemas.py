"""Fixed schemas of the input tables."""

from __future__ import annotations

#: Columns of the tabular hit format, of a mash screen, of alignments and of variant-caller rows.
HITS = "query string, subject string, title string, pident double, qlen long, slen long, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double"
SCREEN = "identity double, `shared-hashes` string, `median-multiplicity` long, `p-value` double, `query-ID` string, `query-comment` string"
SAM = "read_id string, flag int, ref string, pos long, mapq int, cigar string, mate_ref string, mate_pos long, tlen long, seq string, qual string"
MPILEUP = "ref string, pos long, base string, depth long, bases string, quals string"
IDXSTATS = "ref string, length long, mapped long, unmapped long"
VCF = "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string, format string, sample string"
UC = "record string, cluster long, size long, pident string, strand string, a string, b string, cigar string, member string, centroid string"
