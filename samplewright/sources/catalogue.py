"""The catalogue of reference genomes, built from where each genome's files lie.

All paths follow one rule: base/species/provider/build and a folder for each tool.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Species folder, provider, and the builds with their mitochondrial name and effective size.
GENOMES = [
    ("Homo_sapiens", "Ensembl", "GRCh37", "MT", "2.7e9"),
    ("Homo_sapiens", "NCBI", "GRCh38", "chrM", "2.7e9"),
    ("Mus_musculus", "Ensembl", "GRCm38", "MT", "1.87e9"),
    ("Arabidopsis_thaliana", "Ensembl", "TAIR10", "Mt", None),
    ("Bacillus_subtilis_168", "Ensembl", "EB2", None, None),
    ("Bos_taurus", "Ensembl", "UMD3.1", "MT", None),
    ("Caenorhabditis_elegans", "Ensembl", "WBcel235", "MtDNA", "9e7"),
    ("Canis_familiaris", "Ensembl", "CanFam3.1", "MT", None),
    ("Danio_rerio", "Ensembl", "GRCz10", "MT", None),
    ("Drosophila_melanogaster", "Ensembl", "BDGP6", "M", "1.2e8"),
    ("Equus_caballus", "Ensembl", "EquCab2", "MT", None),
    ("Escherichia_coli_K_12_DH10B", "Ensembl", "EB1", None, None),
    ("Gallus_gallus", "Ensembl", "Galgal4", "MT", None),
    ("Glycine_max", "Ensembl", "Gm01", None, None),
    ("Macaca_mulatta", "Ensembl", "Mmul_1", "MT", None),
    ("Oryza_sativa_japonica", "Ensembl", "IRGSP-1.0", "Mt", None),
    ("Pan_troglodytes", "Ensembl", "CHIMP2.1.4", "MT", None),
    ("Rattus_norvegicus", "Ensembl", "Rnor_5.0", "MT", None),
    ("Rattus_norvegicus", "Ensembl", "Rnor_6.0", "MT", None),
    ("Saccharomyces_cerevisiae", "Ensembl", "R64-1-1", "MT", "1.2e7"),
    ("Schizosaccharomyces_pombe", "Ensembl", "EF2", "MT", "1.21e7"),
    ("Sorghum_bicolor", "Ensembl", "Sbi1", None, None),
    ("Sus_scrofa", "Ensembl", "Sscrofa10.2", "MT", None),
    ("Zea_mays", "Ensembl", "AGPv3", "Mt", None),
    ("Homo_sapiens", "UCSC", "hg38", "chrM", "2.7e9"),
    ("Homo_sapiens", "UCSC", "hg19", "chrM", "2.7e9"),
    ("Mus_musculus", "UCSC", "mm10", "chrM", "1.87e9"),
    ("Bos_taurus", "UCSC", "bosTau8", "chrM", None),
    ("Caenorhabditis_elegans", "UCSC", "ce10", "chrM", "9e7"),
    ("Canis_familiaris", "UCSC", "canFam3", "chrM", None),
    ("Danio_rerio", "UCSC", "danRer10", "chrM", "1.37e9"),
    ("Drosophila_melanogaster", "UCSC", "dm6", "chrM", "1.2e8"),
    ("Equus_caballus", "UCSC", "equCab2", "chrM", None),
    ("Gallus_gallus", "UCSC", "galGal4", "chrM", None),
    ("Pan_troglodytes", "UCSC", "panTro4", "chrM", None),
    ("Rattus_norvegicus", "UCSC", "rn6", "chrM", None),
    ("Saccharomyces_cerevisiae", "UCSC", "sacCer3", "chrM", "1.2e7"),
    ("Sus_scrofa", "UCSC", "susScr3", "chrM", None),
]
# Builds without a README, builds without genes, and the blacklists.
WITHOUT_README = {"GRCh38", "WBcel235", "GRCz10", "BDGP6", "Galgal4", "IRGSP-1.0", "Rnor_5.0", "Rnor_6.0", "R64-1-1", "AGPv3", "hg38", "bosTau8", "danRer10", "dm6", "rn6"}
WITHOUT_GENES = {"sacCer3"}
BLACKLISTS = {"GRCh37": "GRCh37", "GRCh38": "hg38", "GRCm38": "GRCm38", "hg38": "hg38", "hg19": "hg19", "mm10": "mm10"}
# Where each attribute lies below a build.
FILES = {
    "fasta": "Sequence/WholeGenomeFasta/genome.fa",
    "bwa": "Sequence/BWAIndex/version0.6.0/",
    "bowtie2": "Sequence/Bowtie2Index/",
    "star": "Sequence/STARIndex/",
    "bismark": "Sequence/BismarkIndex/",
    "gtf": "Annotation/Genes/genes.gtf",
    "bed12": "Annotation/Genes/genes.bed",
    "readme": "Annotation/README.txt",
}


def entries(base: str, assets: str) -> list[tuple[str, str, str]]:
    """(genome, attribute, value), without what a genome lacks."""
    rows = []
    for species, provider, build, mito, size in GENOMES:
        for attr, below in FILES.items():
            if not (attr == "readme" and build in WITHOUT_README) and not (attr in ("gtf", "bed12") and build in WITHOUT_GENES):
                rows.append((build, attr, f"{base}/{species}/{provider}/{build}/{below}"))
        rows += [(build, "mito_name", mito)] * (mito is not None) + [(build, "macs_gsize", size)] * (size is not None)
        if build in BLACKLISTS:
            rows.append((build, "blacklist", f"{assets}/blacklists/{BLACKLISTS[build]}-blacklist.bed"))
    return rows


def genomes(spark: SparkSession, base: str, assets: str = "assets", ignore: bool = False) -> DataFrame:
    """The catalogue as (key, attr, value); empty if it is to be ignored."""
    return spark.createDataFrame([] if ignore else entries(base, assets), "key string, attr string, value string")
